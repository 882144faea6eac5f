import base64
import gzip
import hashlib

import pytest

from snaplake.llm.warc import archive, digest32, parse, read_warc, record, write_warc

PAGES = "page_id long, url string, html string, digest string, first long"


@pytest.fixture
def pages(spark):
    return lambda rows, parts=3: spark.createDataFrame([(i, u, h, "d", 1) for i, u, h in rows], PAGES).repartition(parts)


def rows():
    out = [(i, f"http://h/{i}?é", f"<p>{i}</p>" * (i % 50)) for i in range(200)]
    out += [(500 + i, "http://copy/", "<p>shared</p>\r\n\r\n") for i in range(70)]
    return out + [(7, "http://h/7?é", "<p>7</p>" * 7), (7, "again", "other"), (900, None, None), (901, "a\r\nWARC-Type: x", ""), (None, "n", "<p>3</p>" * 3),
                  (902, "big", "日本" * 200_000)]


def want(table, least=0):
    first = {}
    for i, _, h in table:
        b = (h or "").encode()
        if len(b) >= least:
            first[b] = min(first.get(b, (True, 1 << 60)), (i is not None, i or 0))
    out, seen = [], set()
    for i, _, h in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (h or "").encode()
        repeat = b in first and (first[b] != (i is not None, i or 0) or (i, b) in seen)
        seen.add((i, b))
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i or -1, len(b), digest, "revisit" if repeat else "response", (first[b][1] if first[b][0] else None) if repeat else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [0, 5, 10_000])
def test_round_trip(pages, least):
    df = archive(pages(rows()), min_bytes=least, records_per_shard=40, roll_bytes=2000)
    assert got(df) == want(rows(), least)
    texts = {(r.page_id, bytes(r.payload).decode()) for r in df.collect() if r.record_type == "response"}
    assert texts <= {(i, h or "") for i, _, h in rows()}


def test_files_are_gzip_sorted_rolled_and_the_same_again(pages, tmp_path):
    one, two = f"file://{tmp_path}/one", f"{tmp_path}/two"
    manifest = write_warc(pages(rows()), one, records_per_shard=60, roll_bytes=3000).orderBy("shard", "part").collect()
    again = write_warc(pages(rows(), 7), two, records_per_shard=60, roll_bytes=3000).orderBy("shard", "part").collect()
    assert manifest == again and sum(r.records for r in manifest) == len(rows()) and len({r.shard for r in manifest}) > 1 and max(r.part for r in manifest) > 0
    last = None
    for r in manifest:
        data = (tmp_path / "one" / r.file).read_bytes()
        assert data == (tmp_path / "two" / r.file).read_bytes() and len(data) == r.bytes
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        assert last is None or r.first_page is None or last <= r.first_page
        last = r.last_page if r.last_page is not None else last
    assert not list((tmp_path / "one/_temporary").iterdir())


def test_what_a_failed_attempt_left_is_not_read(pages, tmp_path):
    manifest = write_warc(pages(rows()), str(tmp_path), records_per_shard=60)
    (tmp_path / "_temporary" / "0-shard-000000-0000.warc.gz").write_bytes(b"half")
    assert got(read_warc(manifest, str(tmp_path))) == want(rows())


def test_damage_is_found(pages, tmp_path):
    manifest = write_warc(pages(rows()[:30]), str(tmp_path))
    file = tmp_path / manifest.first().file
    data = gzip.decompress(file.read_bytes())
    file.write_bytes(gzip.compress(data.replace(b"<p>5</p>", b"<p>6</p>", 1)))
    with pytest.raises(Exception, match="does not match"):
        read_warc(manifest, str(tmp_path)).collect()


def test_a_record_alone():
    fields, block = parse(record(5, "http://x y\n", b"abc", None, True))
    assert fields["WARC-Target-URI"] == "http://x%20y%0A" and block.endswith(b"\r\n\r\nabc")
    assert fields["WARC-Payload-Digest"] == "sha1:" + digest32(b"abc")


def test_empty_table(pages):
    assert archive(pages([(1, "u", "h")]).limit(0)).collect() == []
