import hashlib

from facetflow.llm import warc


def archive(n=6, size=300):
    parts = []
    for k in range(n):
        payload = bytes([65 + k]) * size
        raw = warc.record(k, f"http://x/{k}", None, hashlib.sha256(payload).hexdigest(), len(payload), payload, "1970-01-01T00:00:00Z")
        parts.append(raw)
    return parts


def members(parts):
    import gzip

    return [gzip.compress(p, 6, mtime=0) for p in parts]


def ids(data):
    return [(h["warc-record-id"] if h else (s, e)) for s, e, h, _ in warc.salvage(data)]


def name(k):
    return f"<urn:page:{k}>"


def test_whole_archives_have_no_gap():
    parts = archive()
    assert ids(b"".join(members(parts))) == ids(b"".join(parts)) == [name(k) for k in range(6)]
    assert ids(b"") == []


def test_a_damaged_member_is_a_gap_and_later_ones_are_read():
    m = members(archive())
    bad = bytearray(m[2])
    bad[len(bad) // 2] ^= 0xFF
    data = b"".join([*m[:2], bytes(bad), *m[3:]])
    start = len(m[0]) + len(m[1])
    assert ids(data) == [name(0), name(1), (start, start + len(m[2])), name(3), name(4), name(5)]


def test_a_wrong_digest_length_or_end_is_a_gap():
    parts = archive()
    parts[1] = parts[1].replace(b"BBBB", b"XXXX", 1)
    parts[3] = parts[3].replace(b"Content-Length: 3", b"Content-Length: 9")
    found = ids(b"".join(parts))
    assert [x for x in found if isinstance(x, str)] == [name(0), name(2), name(4), name(5)]
    assert len([x for x in found if isinstance(x, tuple)]) == 2


def test_noise_cuts_and_bytes_between():
    m = members(archive())
    data = b"noise" + m[0] + b"\x1f\x8b\x08rubbish" + m[1] + m[2][:40]
    assert ids(data) == [(0, 5), name(0), (5 + len(m[0]), 5 + len(m[0]) + 10), name(1), (len(data) - 40, len(data))]


def test_every_single_byte_error_loses_one_record_at_most():
    m = members(archive(3, 120))
    data = b"".join(m)
    for at in range(0, len(data), 7):
        bad = bytearray(data)
        bad[at] ^= 0x55
        found = list(warc.salvage(bytes(bad)))
        assert sum(h is not None for _, _, h, _ in found) >= 2
        assert sum(e - s for s, e, _, _ in found) == len(data)


def test_a_record_of_several_members(monkeypatch):
    import gzip

    raw = archive(1, 5000)[0]
    cut = [gzip.compress(raw[a : a + 999], mtime=0) for a in range(0, len(raw), 999)]
    tail = members(archive(2))
    assert ids(b"".join(cut) + tail[1]) == [name(0), name(1)]
    assert ids(b"".join(cut[:3] + cut[4:]) + tail[1])[-1] == name(1)


def test_round_trip_through_spark(spark, tmp_path):
    page = "<p>" + "é" * 100
    rows = [
        (5, "http://a", page, "x"), (3, "http://b\r\nWARC-Type: evil", page, "x"), (9, None, page, "x"), (9, None, page, "x"),
        (4, "u", "short", "x"), (2, "u", "short", "x"), (7, "u", None, "x"), (8, "u", "", "x"), (None, "u", page, "x"),
        (1, "u", "z" * 3_000_000 + page, "x"), (6, "u", "\r\n\r\nWARC/1.1\r\n\x1f\x8b\x08" + "q" * 200, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert {r.kind for r in got} == {"record"} and len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.record_id, []).append(r)
    for page_id, _, html, _ in rows:
        raw = (html or "").encode()
        for r in by_id[f"<urn:page:{'' if page_id is None else page_id}>"]:
            assert r.payload_bytes == len(raw) and r.payload_digest == hashlib.sha256(raw).hexdigest()
            assert bytes(r.payload) == (raw if r.record_type == "response" else b"")
    kinds = {k: {(r.record_type, r.refers_to) for r in v} for k, v in by_id.items()}
    assert kinds[name(3)] == {("response", None)}
    assert kinds[name(5)] == kinds[name(9)] == kinds["<urn:page:>"] == {("revisit", name(3))}
    assert kinds[name(4)] == kinds[name(2)] == kinds[name(7)] == {("response", None)}


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = str(tmp_path / "none")
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path).count() == 0


def test_large_members_are_split(spark, tmp_path, monkeypatch):
    import os

    text = os.urandom(9 << 20).hex()  # over MEMBER_BYTES
    pages = spark.createDataFrame([(1, "u", text), (2, "u", "b" * 200)], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "large")
    warc.write_archives(pages, path)
    got = {r.record_id: r for r in warc.read_archives(spark, path).collect()}
    assert bytes(got[name(1)].payload).decode() == text and got[name(2)].record_type == "response"


def test_a_broken_number_is_a_gap(spark, tmp_path):
    parts = archive(3)
    for wrong in (b"X-Payload-Length: 3x0", b"X-Payload-Length: ", b"X-Payload-Length: " + b"9" * 40):
        broken = parts[1].replace(b"X-Payload-Length: 300", wrong)
        data = b"".join(members([parts[0], broken, parts[2]]))
        assert [x for x in ids(data) if isinstance(x, str)] == [name(0), name(2)]
        assert ids(parts[0] + broken + parts[2])[::2] == [name(0), name(2)]
    revisit = warc.record(9, None, 0, "0" * 64, 5, b"", "1970-01-01T00:00:00Z").replace(b"X-Payload-Length: 5", b"X-Payload-Length: five")
    (tmp_path / "part-0").write_bytes(b"".join(members([parts[0], revisit, parts[2]])))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted((r.kind, r.record_id or "") for r in got) == [("gap", ""), ("record", name(0)), ("record", name(2))]


def test_many_false_starts_are_passed_quickly():
    import time

    data = b"\x1f\x8b\x08" * 100_000 + members(archive(1))[0]
    began = time.process_time()
    assert ids(data) == [(0, 300_000), name(0)]
    assert time.process_time() - began < 8
