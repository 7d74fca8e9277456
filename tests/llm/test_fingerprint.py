import base64
import hashlib

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of, words
from seriesmart.llm import fingerprint as fp


def test_every_row_is_edited_with_the_next_one_by_id(spark):
    got = rows_of(fp.edited_fingerprints(odd_docs(spark)))
    plain = [(i, t or "") for i, t, _, _ in odd_texts()]
    assert len(got) == len(plain)
    named = {i: [t for j, t in plain if j == i] for i, _ in plain}
    order = sorted((i for i in named if i is not None and len(named[i]) == 1), reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    for own, following in zip(order, order[1:]):
        between = [i for i in named if i is not None and following < i < own]
        if between:
            continue
        text, after = named[own][0], named[following][0]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = by_id[own]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        chunks = [fp.chunk_set(t.encode()) for t in (text, edited, after)]
        assert row["fingerprint"] == fp.encoded(chunks[0])
        assert row["near_edited"] == fp.containment(chunks[0], chunks[1])
        assert row["near_next"] == fp.containment(chunks[0], chunks[2])


def test_the_last_is_followed_by_the_first(spark):
    rows = [(1, "one text here", "en", "s"), (2, "two texts there", "en", "s"), (3, "three of them", "en", "s")]
    got = {r["doc_id"]: r for r in rows_of(fp.edited_fingerprints(frame(spark, rows)))}
    assert got[1]["edited_sha256"] == hashlib.sha256(b"one texthree ").hexdigest()
    alone = rows_of(fp.edited_fingerprints(frame(spark, rows[:1])))
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_likeness_follows_what_is_shared():
    text = " ".join(words(4, 900)).encode()
    whole = fp.chunk_set(text)
    assert fp.containment(whole, fp.chunk_set(b"something put in front " + text)) > 0.97
    assert 0.4 < fp.containment(whole, fp.chunk_set(text[: len(text) // 2])) < 0.6
    assert fp.containment(whole, fp.chunk_set(" ".join(words(5, 900, 90_000)).encode())) < 0.05
    assert fp.containment(whole, whole) == 1.0 and fp.containment(whole[:0], whole[:0]) == 1.0
    assert np.array_equal(fp.decoded(fp.encoded(whole)), whole)


def test_chunks_cover_the_text_and_keep_their_bounds():
    data = np.frombuffer(" ".join(words(6, 2000)).encode(), np.uint8)
    ends = fp.cut_points(data)
    lengths = np.diff([0, *ends])
    assert ends[-1] == len(data) and lengths[:-1].min() >= fp.MIN_CHUNK and lengths.max() <= fp.MAX_CHUNK
    assert 16 < lengths.mean() < 64


def test_empty_table(spark):
    assert rows_of(fp.edited_fingerprints(empty_docs(spark))) == []


MASK = (1 << 64) - 1


def splitmix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def by_bytes(text):
    """Chunks, their digests and the fingerprint, one byte after the other."""
    random = [splitmix((b + 1) * 0x9E3779B97F4A7C15 & MASK) for b in range(256)]
    found, chunk, gear = set(), [], 0
    for at, b in enumerate(text):
        gear = (gear << 1) + (random[b] >> 32) & 0xFFFFFFFF
        chunk.append(b)
        zeros = 7 if len(chunk) < fp.NORMAL_CHUNK else 4
        cut = len(chunk) >= fp.MIN_CHUNK and gear >> 32 - zeros == 0
        if cut or len(chunk) == fp.MAX_CHUNK or at == len(text) - 1:
            digest, place = 0, 1
            for c in chunk:
                place = place * 0xD6E8FEB86659FD93 & MASK
                digest = digest + random[c] * place & MASK
            found.add((splitmix(digest) >> 24, len(chunk)))
            chunk = []
    return found


def share(own, other):
    if not own:
        return float(not other)
    return sum(n for d, n in own if (d, n) in other) / sum(n for _, n in own)


def test_fingerprints_byte_by_byte(spark):
    texts = ["", "x", "ab" * 400, " ".join(words(8, 700)), "größe " * 90 + " ".join(words(8, 500)), "\x00" * 300, " ".join(words(11, 60))]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in rows_of(fp.edited_fingerprints(frame(spark, rows)))}
    for i, text in enumerate(texts):
        after = texts[i - 1]  # by descending id; the first one follows the last
        half = len(text) // 2
        own, edited, following = (by_bytes(t.encode()) for t in (text, text[: len(text) - half] + after[:half], after))
        packed = b"".join(d.to_bytes(5, "big") + bytes([n]) for d, n in sorted(own))
        assert base64.b64decode(got[i]["fingerprint"]) == packed
        assert np.isclose(got[i]["near_edited"], share(own, edited)) and np.isclose(got[i]["near_next"], share(own, following))
