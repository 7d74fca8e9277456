"""Chat formatting at token level: reserved ids around separately encoded texts, and loss masks."""

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seriesmart.llm.common import ByteTokenizer

# Each control string has an id of its own above the vocabulary, in this order.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"]
BEGIN, END_OF_ANSWER, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, ROLE_END, TURN_END = range(len(CONTROLS))
TO_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
ENCODED = "conv_id long, turn long, role string, text string, ids array<int>, loss array<byte>"
ASSEMBLED = "conv_id long, part int, ids array<int>, loss array<byte>"
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    """A backslash goes before each backslash, and behind the first sign of each control string."""
    return TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _segments(role: str | None, text: str | None, reserved: int):
    """Of one turn: (reserved id or text, whether it bears loss)."""
    text = escape(text or "")
    if role == "assistant":
        return [(text, 1), (reserved + END_OF_ANSWER, 0)]
    if role == "user":
        return [(reserved + USER, 0), (text, 0), (reserved + USER_END, 0)]
    if role == "system":
        return [(reserved + SYSTEM, 0), (text, 0), (reserved + SYSTEM_END, 0)]
    named = escape(role or "")
    return [(reserved + ROLE, 0), (named, 0), (reserved + ROLE_END, 0), (text, 0), (reserved + TURN_END, 0)]


def format_chats(turns: DataFrame, tokenizer: str, reserved: int = 50257) -> DataFrame:
    """Conversations as token ids with a loss mask; rows ``(conv_id, part)`` in order of parts.

    A template of the kind ``<s>[INST] ask [/INST] answer </s>``. Texts and markers are never
    joined before encoding: every text is encoded by itself and the ids of the markers are
    spliced in between, so no text can make up a marker. Control strings inside texts are
    escaped, which :func:`unescape` reverts. The mask is 1 on the ids of assistant texts, from
    +1 and -1 at the ends of segments by prefix sums.

    Turns are ordered by turn (null first), then role and text. Null text and null role are
    empty; a role that is not user, assistant or system is written out between markers. A
    null conv_id is a conversation too. Each turn is encoded where it is read; afterwards a
    conversation streams through one task in sorted order, turn by turn, so one of any length
    needs the memory of a batch. Repeated rows are turns of their own, other columns are
    not read, and an empty table gives no rows.
    """

    def encode(batches):
        ids_of = ByteTokenizer(tokenizer, special=False).ids
        for batch in batches:
            ids, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                pieces = [
                    (np.frombuffer(ids_of(s), "<u4") if isinstance(s, str) else np.array([s], "<u4"), loss)
                    for s, loss in _segments(role, text, reserved)
                ]
                ends = np.cumsum([len(p) for p, _ in pieces])
                steps = np.zeros(ends[-1] + 1, np.int8)
                for (piece, loss), end in zip(pieces, ends):
                    steps[end - len(piece)] += loss
                    steps[end] -= loss
                ids.append(np.concatenate([p for p, _ in pieces]).astype(np.int32))
                masks.append(np.cumsum(steps[:-1], dtype=np.int8))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8()))],
                names=["conv_id", "turn", "role", "text", "ids", "loss"],
            )

    def assemble(batches):
        """Parts of one turn; the first one also has the begin marker."""
        last, part = (), 0
        for batch in batches:
            keys, parts, ids, masks = batch.column("conv_id").to_pylist(), [], [], []
            for at, key in enumerate(keys):
                part = part + 1 if last == (key,) else 0
                last = (key,)
                own, mask = batch.column("ids")[at].values.to_numpy(), batch.column("loss")[at].values.to_numpy()
                if part == 0:
                    own = np.concatenate([[np.int32(reserved + BEGIN)], own])
                    mask = np.concatenate([[np.int8(0)], mask])
                parts.append(part), ids.append(own), masks.append(mask)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(parts, pa.int32()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(masks, pa.list_(pa.int8())),
                ],
                names=["conv_id", "part", "ids", "loss"],
            )

    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    encoded = rows.mapInArrow(encode, ENCODED).repartition("conv_id")
    ordered = encoded.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "ids", "loss")
    return ordered.mapInArrow(assemble, ASSEMBLED)


class Reader:
    """Takes the parts of one conversation apart again."""

    def __init__(self, decode_bytes, reserved: int):
        self.decode = lambda ids: decode_bytes(ids.tolist()).decode()
        self.reserved = reserved
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray) -> None:
        role, named, text = "assistant", None, ""
        marks = np.flatnonzero(ids >= self.reserved)
        bounds = [-1, *marks.tolist(), len(ids)]
        for start, end in zip(bounds, bounds[1:]):
            if end > start + 1:
                text = self.decode(ids[start + 1 : end])
                self.chars += len(text)
            if end == len(ids):
                break
            mark = int(ids[end]) - self.reserved
            self.chars += len(CONTROLS[mark])
            if mark in (USER, SYSTEM, ROLE):
                role = {USER: "user", SYSTEM: "system", ROLE: None}[mark]
            elif mark == ROLE_END:
                role, text = unescape(text), ""
            elif mark in (END_OF_ANSWER, USER_END, SYSTEM_END, TURN_END):
                self.turns += 1
                self.all.update(f"{role}\n{unescape(text)}\n".encode())
                role, text = "assistant", ""
        edges = np.flatnonzero(np.diff(mask, prepend=0, append=0))
        for start, end in zip(edges[::2], edges[1::2]):
            said = unescape(self.decode(ids[start:end]))
            self.loss_chars += len(said)
            self.loss.update(said.encode())

    def row(self, key):
        return (key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame, tokenizer: str, reserved: int = 50257) -> DataFrame:
    """Digests per conversation, from nothing but the ids and masks of :func:`format_chats`.

    Expects the rows as that function returns them: conversations whole and parts in order.
    """

    def run(batches):
        decode, reader, last = ByteTokenizer(tokenizer, special=False).decode_bytes, None, ()
        for batch in chain(batches, [None]):
            rows = []
            for at, key in enumerate([] if batch is None else batch.column("conv_id").to_pylist()):
                if last != (key,):
                    if reader:
                        rows.append(reader.row(*last))
                    reader, last = Reader(decode, reserved), (key,)
                reader.add(batch.column("ids")[at].values.to_numpy(), batch.column("loss")[at].values.to_numpy())
            if batch is None and reader:
                rows.append(reader.row(*last))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return formatted.mapInArrow(run, READ_BACK)


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), written AS (
  SELECT *, length(text) + len(regexp_extract_all(text,
      '<</SYS>>|<<SYS>>|\[/INST\]|\[/ROLE\]|\[INST\]|\[ROLE\]|\[END\]|</s>|<s>|\\')) AS escaped,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15 ELSE 18 + length(role) END AS marks
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(escaped + marks) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""
