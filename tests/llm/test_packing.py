import zlib
from collections import defaultdict

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of, words
from seriesmart.llm import packing
from seriesmart.llm.common import ByteTokenizer
from seriesmart.llm.queries import tokenizer
from tokenizers import Tokenizer

TEXTS = [t or "" for _, t, _, _ in odd_texts()] + [
    " starts blank", "ends blank ", "a\n b", "a \n b", "x  y", "tab\t\tand  two", "it's we'll I'M 'S", "a\x1cb\x1c c", "　全角　 空白",
    "🙂🙂 é ", "<|endoftext|>x <|endoftext|> y", "no_blank_at_all" * 50, "\r\n\r\n  z", "1 23 456 .,;! ?",
]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


LIBRARY = Tokenizer.from_file(tokenizer())


def test_ids_are_those_of_the_library():
    own = ByteTokenizer(tokenizer(), special=True)
    for text in TEXTS:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library_ids(text), text[:80]


def test_long_texts_are_encoded_in_slices(monkeypatch):
    monkeypatch.setattr("seriesmart.llm.common.SLICE_CHARS", 50)
    own = ByteTokenizer(tokenizer(), special=True)
    for text in TEXTS:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library_ids(text)


def test_pieces_hold_all_ids_and_sequences_have_no_gaps(spark):
    got = rows_of(packing.pack(odd_docs(spark), tokenizer(), length=64))
    wanted = []
    for doc_id, text, _, _ in odd_texts():
        ids = np.array([*library_ids(text or ""), 2], "<u4")
        start = 0
        for piece, end in enumerate(range(len(ids) % 64 or 64, len(ids) + 1, 64)):
            part = ids[start:end]
            wanted.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            start = end
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got))) == sorted(map(str, wanted))
    places = defaultdict(list)
    for row in got:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for own in places.values():
        own.sort()
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 64


def test_few_sequences_and_few_open_bins():
    sizes = np.random.default_rng(2).integers(1, 1025, 6000).tolist()
    bins = packing.OpenBins(1024, 4096)
    for start in range(0, 6000, 1000):
        for size in sorted(sizes[start : start + 1000], reverse=True):
            bins.place(size)
    assert bins.made <= 1.02 * sum(sizes) / 1024
    few = packing.OpenBins(1024, 8)
    for size in sizes:
        few.place(size)
        assert few.open <= 8 and sum(map(len, few.by_space.values())) == few.open


def test_the_tightest_bin_is_taken_and_the_fullest_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(6), bins.place(7)] == [(0, 0), (1, 0)]
    assert bins.place(3) == (1, 7)  # exactly full, closed
    assert bins.place(5) == (2, 0)
    assert bins.place(9) == (3, 0)  # bin 0, the fuller of 0 and 2, closes for it
    assert bins.place(4) == (2, 5)


def by_list_scan(sizes, length, capacity):
    """Best-fit with a bounded number of open bins, straight from its definition."""
    open_, made, out = [], 0, []
    for size in sizes:
        fitting = [b for b in open_ if b[1] >= size]
        if fitting:
            best = min(fitting, key=lambda b: b[1])
        else:
            if len(open_) >= capacity:
                open_.remove(min(open_, key=lambda b: b[1]))
            best = [made, length]
            open_.append(best)
            made += 1
        out.append((best[1], length - best[1]))
        best[1] -= size
        if not best[1]:
            open_.remove(best)
    return out, made


def test_spaces_are_those_of_a_list_scan():
    for seed, (length, capacity, n) in enumerate(((20, 3, 400), (64, 10, 1500), (1024, 50, 3000), (5, 1, 60))):
        sizes = np.random.default_rng(seed).integers(1, length + 1, n).tolist()
        bins = packing.OpenBins(length, capacity)
        wanted, made = by_list_scan(sizes, length, capacity)
        assert [bins.place(size)[1] for size in sizes] == [offset for _, offset in wanted]
        assert bins.made == made


def test_sequences_do_not_depend_on_partitions(spark):
    rows = [(i, " ".join(words(i, 20 + 97 * (i % 13))), "en", "s") for i in range(700)]
    docs, fills = frame(spark, rows), []
    for parts in (2, 150):
        got = rows_of(packing.pack(docs.repartition(parts, "doc_id"), tokenizer()))
        places = defaultdict(list)
        for row in got:
            places[row["sequence_id"]].append((row["offset"], row["length"]))
        for own in places.values():
            own.sort()
            ends = np.cumsum([n for _, n in own])
            assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 1024
        assert len({(r["doc_id"], r["piece"]) for r in got}) == len(got)
        fills.append(sum(r["length"] for r in got) / 1024 / len(places))
    assert min(fills) > 0.985 and fills[1] > fills[0] - 0.005, fills


def test_empty_table(spark):
    assert rows_of(packing.pack(empty_docs(spark), tokenizer())) == []
