import hashlib
import io
import re
import zlib

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from gridwright.llm import sharding, warc, winnowing
from tests.llm.conftest import prose

PAGES = "page_id long, url string, html string"


def _pages():
    long, other = "<html>" + prose(1, 200) + "</html>", "<p>" + prose(2, 90) + "</p>\r\n\r\nWARC/1.1\r\n"
    return [(4, "http://a.b/ü\r\nX: y", long), (2, "u", long), (9, None, long), (None, "u", long), (2, "u", long), (5, "u", "short"),
            (6, "u", "short"), (7, "u", None), (8, "u", ""), (10, "u", other), (None, "v", "n" * 300), (None, "v", "n" * 300),
            (11, "u", "é" * 50), (12, "u", "é" * 50), (13, "u", prose(3, 30_000))]


def _expected(pages):
    least = {}
    for i, _, h in pages:
        if i is not None:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        revisit = len(raw) >= 100 and h in least and i != least[h]
        out.append(tuple(map(str, (i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                                   least[h] if revisit else None))))
    return sorted(out)


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 2000])
def test_archives_round_trip(spark, archive_bytes):
    pages = spark.createDataFrame(_pages(), PAGES).selectExpr("*", "'x' AS digest", "'y' AS least", "1 AS copies")
    archives = warc.write_archives(pages, archive_bytes=archive_bytes)
    rows = warc.read_archives(archives).collect()
    got = sorted(tuple(map(str, (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))) for r in rows)
    assert got == _expected(_pages())
    assert {r.payload for r in rows if r.record_type == "response"} == {h or "" for _, _, h in _pages()}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_records_are_single_frames_after_the_dictionary():
    records = [warc.record(n, "u", prose(n, 200).encode(), "d", None, "response") for n in range(300)]
    first, *frames = warc.archive_parts(records)
    assert int.from_bytes(first[:4], "little") == 0x184D2A5D and int.from_bytes(first[4:8], "little") == len(first) - 8
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(first[8:]))
    assert [reader.decompress(f) for f in frames] == records
    plain = zstandard.ZstdCompressor(level=warc.LEVEL)
    assert sum(map(len, frames)) < sum(len(plain.compress(r)) for r in records)
    fields = [f["WARC-Record-ID"] for f, _ in warc.read_archive(io.BytesIO(b"".join([first, *frames])))]
    assert fields == [f"<urn:page:{n}>" for n in range(300)]
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(b"".join(frames))))


def _check_shards(rows, pairs, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs)
    bytes_of, slots = dict.fromkeys(range(shards), 0), {k: [] for k in range(shards)}
    for r in rows:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return bytes_of


def test_shards_have_near_equal_bytes(documents):
    pairs = [(i, prose(i % 400, 20 + i % 37)) for i in range(1500)] + [(5000 + i, prose(7, 50)) for i in range(700)]
    sizes = _check_shards(sharding.kd_shards(documents(pairs), 24).collect(), pairs, 24).values()
    assert max(sizes) - min(sizes) < 0.05 * max(sizes)


def test_shards_of_awkward_rows(documents, awkward):
    frame = documents(awkward)
    for shards in (1, 2, 5, 24):
        _check_shards(sharding.kd_shards(frame, shards).collect(), awkward, shards)
    total = sum(len((t or "").encode()) + 8 for _, t in awkward)
    by_target = sharding.kd_shards(frame, target_bytes=total // 3 + 1).collect()
    assert max(r.shard for r in by_target) <= 2
    assert sharding.kd_shards(frame.limit(0), 24).count() == 0


def test_equal_rows_are_cut_only_when_they_must_be(documents):
    pairs = [(1, prose(1, 60))] * 40
    sizes = _check_shards(sharding.kd_shards(documents(pairs), 4).collect(), pairs, 4)
    assert sum(sizes.values()) == 40 * (len(pairs[0][1].encode()) + 8)
    apart = [(n, prose(n // 30, 60)) for n in range(120)]
    rows = sharding.kd_shards(documents(apart).withColumn("source", F.lit("s")).withColumn("lang", F.lit("l")), 2).collect()
    assert len({r.shard for r in rows}) == 2


def _marks(text):
    words = [w for w in re.split("[ \t-\r]+", (text or "").lower()) if w]
    prime, base = 2**31 - 1, 1_000_003

    def hashed(word):
        value = xxhash.xxh64_intdigest(word.encode(), 42)
        return (value - 2**64 if value >= 2**63 else value) % prime

    def gram(hashes):
        out = 0
        for h in hashes:
            out = (out * base + h) % prime
        return out

    hashes = [hashed(w) for w in words]
    grams = [gram(hashes[i:i + 5]) for i in range(len(hashes) - 4)] or ([gram(hashes)] if hashes else [])
    kept = {}
    for start in range(max(len(grams) - 15, 1) if grams else 0):
        window = grams[start:start + 16]
        at = start + max(i for i, g in enumerate(window) if g == min(window))
        kept[at] = grams[at]
    return sorted(kept.items())


def _like(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing_equals_brute_force(documents, awkward):
    pairs = [p for p in awkward if p[0] != 12 and p[1] != dict(awkward)[11]] + [(20, prose(1, 300)), (21, prose(6, 20)), (22, "b " * 19)]
    rows = winnowing.edited_fingerprints(documents(pairs)).collect()
    assert len(rows) == len(pairs)
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (2**64 if xxhash.xxh64_intdigest(t.encode(), 42) >= 2**63 else 0)
    order = sorted({(i is not None, i or 0, signed(t or ""), t or "") for i, t in pairs})
    want = []
    for i, text in pairs:
        text = text or ""
        at = order.index((i is not None, i or 0, signed(text), text))
        following = order[(at + 1) % len(order)][3]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, changed, after = _marks(text), _marks(edited), _marks(following)
        written = lambda m: ",".join(f"{p}:{h:X}" for p, h in m)
        want.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed),
                     round(_like(own, changed), 9), round(_like(own, after), 9)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
           for r in rows]
    assert sorted(got) == sorted(want)


def test_shared_runs_share_a_mark(documents):
    shared = prose(50, winnowing.GRAM + winnowing.WINDOW - 1)
    pairs = [(n, f"{prose(60 + n, 40 + n)} {shared} {prose(80 + n, 30)}") for n in range(6)]
    rows = winnowing.fingerprints(documents(pairs)).collect()
    hashes = [{m >> 32 for m in r.marks} for r in rows]
    assert all(a & b for a in hashes for b in hashes)


def test_winnowing_stays_in_the_engine(documents, awkward):
    plans = [winnowing.edited_fingerprints(documents(awkward)), sharding.kd_shards(documents(awkward), 4)]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert winnowing.edited_fingerprints(documents(awkward).limit(0)).count() == 0
    assert winnowing.edited_fingerprints(documents([(3, "alone in the table")])).first().near_next == 1.0
