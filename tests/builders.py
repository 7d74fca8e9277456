"""Small hand-made inputs: workbooks, archives and grids."""

import io
import zipfile
from xml.sax.saxutils import escape

from seriesmart.schemas import CELL_GRID


def _letters(index):
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def workbook_bytes(sheets):
    """sheets: {name: {row number: [cells]}}; texts alternate between shared and inline."""
    texts, parts = [], {}
    names = list(sheets)
    for at, name in enumerate(names, start=1):
        rows = []
        for number, cells in sorted(sheets[name].items()):
            body = ""
            for place, value in enumerate(cells):
                ref = f"{_letters(place)}{number}"
                if value is None:
                    continue
                if isinstance(value, (int, float)):
                    body += f'<c r="{ref}"><v>{value}</v></c>'
                elif place % 2:
                    body += f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
                else:
                    texts.append(value)
                    body += f'<c r="{ref}" t="s"><v>{len(texts) - 1}</v></c>'
            rows.append(f'<row r="{number}">{body}</row>')
        parts[f"xl/worksheets/sheet{at}.xml"] = f"<worksheet><sheetData>{''.join(rows)}</sheetData></worksheet>"
    link = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    listed = "".join(f'<sheet name="{escape(n)}" r:id="rId{at}"/>' for at, n in enumerate(names, start=1))
    parts["xl/workbook.xml"] = f"<workbook {link}><sheets>{listed}</sheets></workbook>"
    targets = "".join(
        f'<Relationship Id="rId{at}" Target="worksheets/sheet{at}.xml"/>' for at in range(1, len(names) + 1)
    )
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{targets}</Relationships>"
    parts["xl/sharedStrings.xml"] = "<sst>" + "".join(f"<si><t>{escape(t)}</t></si>" for t in texts) + "</sst>"
    return archive_bytes(parts)


def archive_bytes(parts):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts.items():
            archive.writestr(name, content)
    return held.getvalue()


def grid_rows(file, sheet, first_row, rows, sheet_idx=0):
    return [(file, sheet_idx, sheet, number, list(cells)) for number, cells in enumerate(rows, start=first_row)]


def grid(spark, rows):
    return spark.createDataFrame(rows, CELL_GRID)


def as_tuples(df, *columns):
    return sorted(
        (tuple(row) for row in df.select(*columns).collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )
