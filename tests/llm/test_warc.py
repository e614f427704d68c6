import base64
import hashlib

import pytest

from custval.llm.warc import SAVED, deduplicated_records, member, read_archives, record, salvage, write_archives

PAGES = [(3, "http://a/é", "<p>x</p>"), (1, "http://b/\r\nX: y", "<p>x</p>"), (2, None, None), (4, "u", ""), (5, "u", "ü" * 5000), (5, "u", "ü" * 5000),
         (None, "n", "<p>x</p>"), (6, "v", "only"), (7, "w", "WARC/1.1\r\nno record\r\n\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "z", "z") for p in PAGES], "page_id long, url string, html string, id string, sha string")


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_round_trip(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    write_archives(deduplicated_records(pages), path, archive_bytes=700)
    rows = read_archives(spark, path).collect()
    assert {r.kind for r in rows} == {"record"}
    first = {}
    for i, _, h in PAGES:
        b = (h or "").encode()
        first[b] = min(first.get(b, 99), 99 if i is None else i)
    expected = sorted(((str(i) if i is not None else "null", len((h or "").encode()), sha((h or "").encode()),
                        *(("response", None) if first[(h or "").encode()] == i else ("revisit", str(first[(h or "").encode()])))) for i, _, h in PAGES), key=repr)
    assert sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr) == expected
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}


def test_small_payloads_are_all_responses(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    write_archives(deduplicated_records(pages, min_payload=9), path)
    rows = read_archives(spark, path, payloads=False).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 9) and all(r.payload is None for r in rows)


def test_no_pages(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    write_archives(deduplicated_records(pages.where("false")), path)
    assert read_archives(spark, path).collect() == []


def _records(n):
    return [member(record(str(i), f"http://x/{i}", b"payload %d " % i * 60, None, "2000-01-01T00:00:00Z")) for i in range(n)]


def test_salvage_covers_every_byte_and_recovers_the_rest():
    recs = _records(6)
    plain = record("9", None, b"zz\r\n\r\nWARC", None, "d")
    for k in range(len(recs)):
        for at in (0, 2, len(recs[k]) // 2, len(recs[k]) - 3):
            broken = bytearray(recs[k])
            broken[at] ^= 0x55
            data = b"".join(recs[:k]) + bytes(broken) + b"".join(recs[k + 1:]) + b"\0" + plain + b"rubbish"
            found = list(salvage(data))
            assert [f[3]["warc-record-id"] for f in found if f[2] is None and SAVED not in f[3]] == [f"<{i}>" for i in range(6) if i != k] + ["<9>"]
            saved = [f for f in found if SAVED in f[3]]
            assert all(f[3]["warc-record-id"] == f"<{k}>" and f[4] == b"payload %d " % k * 60 for f in saved)
            assert len(saved) == 1 or at < len(recs[k]) - 3            # a fault in the trailer leaves the record whole
            gaps = [f for f in found if f[2]]
            assert gaps[0][0] == sum(map(len, recs[:k])) and data[gaps[-1][0]:] == b"rubbish"
            found = [f for f in found if SAVED not in f[3]]
            assert all(a[1] <= b[0] and not data[a[1]:b[0]].strip(b"\0") for a, b in zip(found, found[1:]))


def test_salvage_of_cut_and_foreign_data():
    a, b = _records(2)
    assert [f[2] for f in salvage(a + b[:-9])] == [None, None, "gzip: cut off"]        # the trailer and a byte: the record is whole
    assert [f[2] for f in salvage(a + b[:-40])] == [None, "gzip: cut off"]
    assert [f[2] for f in salvage(b"nothing here")] == ["no version line"]
    assert list(salvage(b"")) == [] and list(salvage(b"\0" * 9)) == []
    wrong = record("1", None, b"abc", None, "d").replace(b"abc\r\n", b"abd\r\n")
    assert [f[2] for f in salvage(wrong + a)] == ["block digest differs", None]
    assert [f[2] for f in salvage(member(wrong) + a)] == ["block digest differs", None]


def test_records_directly_behind_damage():
    """A plain record cut off inside its payload, or a damaged member, is followed at once by a plain record."""
    plain = [record(str(i), f"http://x/{i}", b"payload %d " % i * 9, None, "d") for i in range(3)]
    for cut in (7, 30, len(plain[0]) - 20, len(plain[0]) - 5):
        assert [(f[2] is None, f[3].get("warc-record-id")) for f in salvage(plain[0][:cut] + plain[1] + plain[2])] == [(False, None), (True, "<1>"), (True, "<2>")]
    whole = member(plain[0])
    for broken in (whole[:-12], whole[:20], whole[:-3] + b"\x55" + whole[-2:]):
        found = list(salvage(broken + plain[1] + member(plain[2])))
        saved = ["<0>"] if len(broken) == len(whole) else []               # only its trailer is bad
        assert [f[3].get("warc-record-id") for f in found] == [*saved, None, "<1>", "<2>"] and found[0][:2] == (0, len(broken))


def test_members_of_several_records():
    """Every valid record of a member is found, with a gap in the member's range for each bad stretch."""
    plain = [record(str(i), f"http://x/{i}", b"payload %d " % i * 9, None, "d") for i in range(4)]
    bad = plain[1].replace(b"payload 1 payload", b"payload 1 pay.oad")
    ids = lambda found: [f[3]["warc-record-id"] if f[2] is None else f[2] for f in found]
    one = member(b"".join(plain))
    assert ids(salvage(one)) == ["<0>", "<1>", "<2>", "<3>"]
    mixed = member(plain[0] + bad + plain[2] + plain[3][:-30] + plain[3] + b"rubbish")
    found = list(salvage(b"junk" + mixed + one))
    assert ids(found) == ["no version line", "<0>", "block digest differs", "<2>", "Content-Length does not fit", "<3>", "no version line",
                          "<0>", "<1>", "<2>", "<3>"]
    assert {f[:2] for f in found[1:7]} == {(4, 4 + len(mixed))} and {f[:2] for f in found[7:]} == {(4 + len(mixed), 4 + len(mixed) + len(one))}
    assert ids(salvage(member(bad + plain[2]))) == ["block digest differs", "<2>"]
    assert ids(salvage(member(b"") + one)) == ["no version line", "<0>", "<1>", "<2>", "<3>"]


def test_pages_with_long_urls(spark, tmp_path):
    path, url = str(tmp_path / "warc"), "http://a/" + "u" * (2 << 20)
    pages = spark.createDataFrame([(1, url, "<p>x</p>"), (2, "http://b", "y"), (3, url, "<p>x</p>")], "page_id long, url string, html string")
    write_archives(deduplicated_records(pages), path)
    rows = read_archives(spark, path).collect()
    assert sorted((r.kind, r.record_id, r.target_uri, r.record_type) for r in rows) == [
        ("record", "1", url, "response"), ("record", "2", "http://b", "response"), ("record", "3", url, "revisit")]
    plain = record("1", url, b"x", None, "d")
    assert [f[2] for f in salvage(plain[:-9] + plain + b"WARC/1.0\r\n")] == ["header field repeated", None, "header not ended"]


def test_damaged_members_give_what_comes_before_the_fault():
    """A bad trailer, a cut or a flipped byte costs only the records behind it; the rest of the member is one gap."""
    plain = [record(str(i), f"http://x/{i}", b"%d payload " % (i * 7919) * 40, None, "d") for i in range(5)]
    one, more = member(b"".join(plain)), member(plain[0])
    ids = lambda found: [f[3]["warc-record-id"] if f[2] is None else "gap" for f in found]
    assert ids(salvage(one[:-6] + b"\x00" + one[-5:] + more)) == ["<0>", "<1>", "<2>", "<3>", "<4>", "gap", "<0>"]
    for cut in (8, 30, 90):
        found = ids(salvage(one[:-cut] + more))
        n = found.index("gap")
        assert found == [f"<{i}>" for i in range(n)] + ["gap", "<0>"] and n >= (5 if cut <= 8 else 1)
    found = list(salvage(one[:-30]))
    assert {f[:2] for f in found} == {(0, len(one) - 30)} and found[-1][2] == "gzip: cut off"
    # without a digest of its own nothing tells a damaged record from a whole one
    bare = plain[0].replace(b"WARC-Block-Digest", b"X-Block-Digest")
    assert ids(salvage(member(bare)[:-3])) == ["gap"] and ids(salvage(member(bare))) == ["<0>"]


def test_hot_and_small_payloads(spark, tmp_path):
    """A payload that most pages share, and small ones without a key, are dealt out and give the same records."""
    rows = [(i, None, "the same page" if i % 3 else f"page {i}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least, first in ((0, "1"), (1000, None)):
        out = deduplicated_records(pages, min_payload=least).collect()
        assert sorted(int(r.record_id) for r in out) == list(range(600))
        assert all(r.refers_to == (first if int(r.record_id) % 3 and r.record_id != "1" else None) for r in out)
