import base64
import collections
import gzip
import hashlib
import io
import random

import pytest

from daybook.llm import warc

SCHEMA = "page_id long, url string, html string"


def payload(html):
    return (html or "").encode()


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    page = lambda n: "".join(rng.choice("<p>é\r\n 😀xyz") for _ in range(n))
    long = page(300_000)
    out = [(1, "u1", None), (2, "u2", ""), (3, None, "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (None, "u4", page(40))]
    out += [(5, "u5", long), (6, "u\r\nX-Row-Id: 9", long), (7, "u7", long + "x"), (8, "u8", "\r\n\r\n" * 50)]
    out += [(20 + i, f"c{i}", "copy") for i in range(60)] + [(90, "r", "again")] * 3 + [(None, "n", "again"), (None, "n", "alone")]
    rng.shuffle(out)
    return out


def expected(rows, least_bytes=0):
    ids, size = collections.defaultdict(list), collections.Counter()
    for id, _, html in rows:
        ids[html or ""].append(id)
    out = collections.Counter()
    for id, _, html in rows:
        data = payload(html)
        best = max((x for x in ids[html or ""] if x is not None), default=None)
        size[html or "", id] += 1
        alone = len(data) < least_bytes or (id == best and size[html or "", id] == 1)
        out[id, len(data), digest(data), "response" if alone else "revisit", None if alone else best] += 1
    return out


def got(archives):
    rows = warc.contents(archives).collect()
    assert all(r.intact for r in rows)
    return collections.Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


@pytest.mark.parametrize("chunk,file_bytes,least", [(1 << 20, 128 << 20, 0), (1000, 3000, 0), (7, 1, 5)])
def test_revisits(stored, rows, tmp_path, chunk, file_bytes, least):
    few = [r for r in rows if chunk > 10 or len(r[2] or "") < 1000]
    df = stored(few, SCHEMA, clash=True).repartition(3)
    archives = warc.archive(df, least_bytes=least, folder=f"file://{tmp_path}/out", chunk=chunk, file_bytes=file_bytes)
    assert got(archives) == expected(few, least)
    assert sum(r.n_records for r in archives.collect()) == len(few)


def test_chunks_give_the_payload_back(stored, rows):
    archives = warc.write_archives(stored(rows, SCHEMA))
    chunks = [r for r in warc.read_chunks(archives, chunk=4096).collect()]
    whole = collections.defaultdict(list)
    for r in sorted(chunks, key=lambda r: (r.archive, r.record_no, r.chunk_no)):
        own = whole[r.archive, r.record_no]
        assert r.chunk_no == len(own) and len(r.content) <= 4096
        own.append(bytes(r.content))
        data = b"".join(own)  # the digest so far
        assert (r.n_bytes, r.digest) == (len(data), digest(data))
        assert r.last == (r.n_bytes == r.stated_bytes)
    assert collections.Counter(b"".join(x) for x in whole.values()) == collections.Counter(payload(h) for *_, h in rows)
    assert all((r.length is not None) == r.last for r in chunks)


def test_files_are_standard_gzip_members(stored, rows):
    archives = warc.archive(stored(rows, SCHEMA)).collect()
    kinds = collections.Counter()
    for a in archives:
        raw = gzip.open(a.archive).read()
        stream = io.BytesIO(raw)
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                assert name not in fields
                fields[name] = value
            block = stream.read(int(fields["Content-Length"]))
            http, _, body = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b": ")[2])
            kinds[fields["WARC-Type"]] += 1
            if fields["WARC-Type"] == "response":
                assert len(body) == size and fields["WARC-Payload-Digest"] == f"sha1:{digest(body)}"
            else:
                assert body == b"" and fields["WARC-Profile"] == warc.IDENTICAL and fields["WARC-Refers-To"]
            assert stream.read(4) == b"\r\n\r\n"
    assert kinds == collections.Counter(x[3] for x in expected(rows).elements())


def foreign(kind, body):
    record = warc._header({"WARC-Type": kind, "Content-Type": "text/plain"}, len(body)) + body + b"\r\n\r\n"
    return record


def test_other_archives(spark, tmp_path):
    bodies = [b"", b"a\r\n\r\nb" * 9, b"z" * 5000]
    every = b"".join(foreign("resource", b) for b in bodies)
    (tmp_path / "a.warc").write_bytes(every)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(every))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(gzip.compress(foreign("resource", b)) for b in bodies))
    (tmp_path / "d.warc").write_bytes(b"")
    found = warc.records(warc.read_chunks(warc.list_archives(spark, str(tmp_path)), chunk=64)).collect()
    by = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r.record_no):
        by[r.archive[-9:].lstrip("/")].append((r.n_bytes, r.digest))
        assert r.intact and (r.length is None) == (r.archive.endswith("b.warc.gz"))
    assert len(by) == 3 and all(x == [(len(b), digest(b)) for b in bodies] for x in by.values())


@pytest.mark.parametrize("damage", [lambda b: b[:-40], lambda b: b"no archive at all"])
def test_damaged_archives_fail(spark, tmp_path, damage):
    data = gzip.compress(foreign("resource", b"x" * 500))
    (tmp_path / "a.warc.gz").write_bytes(damage(data))
    with pytest.raises(Exception, match="cut off|no WARC record"):
        warc.read_chunks(warc.list_archives(spark, str(tmp_path))).collect()


def test_altered_payload_is_not_intact(spark, tmp_path):
    record = warc._header({"WARC-Type": "resource", "WARC-Payload-Digest": "sha1:" + digest(b"one")}, 3) + b"two\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record)
    found = warc.records(warc.read_chunks(warc.list_archives(spark, str(tmp_path)))).collect()
    assert [r.intact for r in found] == [False]


def test_empty_table(stored):
    archives = warc.archive(stored([], SCHEMA))
    assert archives.count() == 0 and warc.contents(archives).count() == 0


def test_a_chunk_has_a_byte(stored):
    with pytest.raises(ValueError):
        warc.write_archives(stored([], SCHEMA), chunk=0)
