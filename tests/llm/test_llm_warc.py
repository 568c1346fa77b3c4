"""WARC bundles: round trips, revisits, seeks and the public format."""

import hashlib
import io
import random

import pytest
import zstandard
from kerbside.llm import warc
from pyarrow import fs as pafs
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, bundle string, payload_digest string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    bodies = [None, "", "x", "é" * 600, "b" * 999, "c" * 1000, "long " * 200_000]
    bodies += ["".join(rng.choices("abc <>\r\n\0é", k=rng.randint(900, 3000))) for _ in range(20)]
    out = [(i, f"http://h{i}.org/ä b\r\nc", rng.choice(bodies)) for i in range(120)]
    return [*out, (None, None, "c" * 1000), (None, "u", None), (500, None, "d" * 2000), (500, None, "d" * 2000)]


@pytest.fixture(scope="module")
def written(spark, rows, tmp_path_factory):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    folder = warc.as_uri(str(tmp_path_factory.mktemp("warc")))
    return warc.write_bundles(warc.mark_revisits(pages), folder)


def plain(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == body and i is not None]
        last = max(same, default=None)
        again = page_id is not None and len(body) >= 1000 and page_id < last
        digest = hashlib.sha1(body).hexdigest()
        out.append((page_id, len(body), digest, "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def test_round_trip(written, rows):
    got = warc.read_bundles(written, payload=True).collect()
    number = lambda x: None if x is None else int(x)
    told = [
        (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in got
    ]
    assert sorted(told, key=str) == plain(rows)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_single_records_by_seek(spark, written):
    entries = written.filter("record_id IN ('3', '77', '500')")
    assert entries.count() == 4
    for r in warc.read_records(entries).collect():
        (one,) = warc.decode_records(bytes(r.record))
        assert one["record_id"] == r.record_id


def test_any_zstandard_reader_unpacks_a_bundle(written):
    uri = written.first().bundle
    system, path = pafs.FileSystem.from_uri(uri)
    data = system.open_input_file(path).read()
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    plain_bytes = reader.read()
    assert plain_bytes.startswith(b"WARC/1.1\r\n")
    assert len(list(warc.decode_records(plain_bytes))) == written.filter(F.col("bundle") == uri).count()


def test_damage_is_noticed():
    record = warc.encode_record("1", "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        list(warc.decode_records(record.replace(b"payload\r\n", b"paylo4d\r\n")))


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    manifest = warc.write_bundles(warc.mark_revisits(none), warc.as_uri(str(tmp_path)))
    assert manifest.count() == 0 and warc.read_bundles(manifest).count() == 0


@pytest.mark.parametrize("tasks", [2, 4, 7])
def test_bundles_are_read_back_in_many_tasks(spark, rows, tmp_path, monkeypatch, tasks):
    """As many tasks as there are bundles, or partitions, also where their numbers agree."""
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        manifest = warc.write_bundles(warc.mark_revisits(pages), warc.as_uri(str(tmp_path)))
        busy = warc.read_bundles(manifest).select(F.spark_partition_id().alias("p")).distinct().count()
        bundles = manifest.select("bundle").distinct().count()
        assert bundles > 1 and busy == min(bundles, tasks)
        assert warc.read_bundles(manifest).count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
