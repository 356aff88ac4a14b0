"""Round trip of archives, rolling, determinism, revisits and damage."""

import glob
import hashlib
import random

import pytest

from mortarline.llm.warc import new_folder, page_records, parse_record, plan_revisits, read_warc, record_bytes, write_warc


def pages(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", "".join(rng.choice("ab é\n") for _ in range(rng.randrange(2500)))) for i in range(120)]
    rows += [(200 + i, "u\r\nv", "same " * 300) for i in range(60)] + [(300 + i, "u", "same") for i in range(9)]
    rows += [(None, None, None), (None, "n", "same " * 300), (5, "twice", "w" * 1200), (5, "twice", "w" * 1200), (400, "long", "z" * 3_000_000)]
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, payload string"), rows


def stored(spark, table, **more):
    folder = new_folder(spark)
    records = page_records(table)
    return folder, write_warc(records, plan_revisits(records), folder, shards=4, **more)


def test_round_trip(spark):
    table, rows = pages(spark)
    folder, manifest = stored(spark, table, roll_bytes=20_000)
    got = read_warc(spark, folder).collect()
    assert len(got) == len(rows) == sum(r["records"] for r in manifest.collect())
    name = lambda i: None if i is None else str(i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = max((j for j, _, h in rows if h == html and j is not None), default=None)
        revisit = len(data) >= 1000 and top != i
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", name(top) if revisit else None,
                     None if revisit else data))
    key = lambda r: (r[0], r[1], r[2], r[3], str(r[4]))
    seen = [(str(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
             None if r["payload"] is None else bytes(r["payload"])) for r in got]
    assert sorted(seen, key=key) == sorted(want, key=key)


def test_same_files_again_and_ranges_in_order(spark):
    table, _ = pages(spark)
    sums = []
    for partitions in (1, 7):
        _, manifest = stored(spark, table.repartition(partitions), roll_bytes=20_000)
        sums.append(sorted((r["name"], r["sha256"], r["bytes"]) for r in manifest.collect()))
    assert sums[0] == sums[1] and len(sums[0]) > 4
    files = sorted(manifest.where("first_id IS NOT NULL").collect(), key=lambda r: r["name"])
    ids = [(int(r["first_id"]), int(r["last_id"])) for r in files]
    assert all(a[1] <= b[0] for a, b in zip(ids, ids[1:], strict=False))


def test_unlisted_files_are_not_read(spark):
    table, rows = pages(spark)
    folder, _ = stored(spark, table)
    with open(folder.removeprefix("file://").removeprefix("file:") + "/shard-000000-99999.warc.gz", "wb") as f:
        f.write(b"left over")
    assert read_warc(spark, folder).count() == len(rows)
    assert not glob.glob(folder.removeprefix("file://") + "/_temporary/*")


def test_damage_is_found():
    data = record_bytes(1, "u", b"payload", False, None)
    assert parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        parse_record(data.replace(b"payload", b"paylaod"))


def test_empty(spark):
    table, _ = pages(spark)
    folder, manifest = stored(spark, table.where("false"))
    assert manifest.count() == 0 and read_warc(spark, folder).count() == 0
