"""Chunk files that arrive over time, bulk files, crawl progress, and which blocks of names meet."""

import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from jobweave.functions.similarity import text_ratio
from jobweave.operators import dedup, entities, ranking
from jobweave.sources import bulk, filesets
from jobweave.streaming.chunks import merge_arrived

CHUNK = T.StructType([T.StructField("stt", T.LongType()), T.StructField("url", T.StringType()), T.StructField("tên công việc", T.StringType())])


def write_chunk(folder, number, rows):
    lines = [json.dumps(dict(zip(("stt", "url", "tên công việc"), r)), ensure_ascii=False) for r in rows]
    (folder / f"chunk-{number}.json").write_text("\n".join(lines), encoding="utf-8")


def test_stream_merges_like_one_batch(spark, tmp_path):
    draw = random.Random(8)
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    chunks = [
        [(i, draw.choice(["", None, *[f"u{k}" for k in range(15)]]), draw.choice(["Kỹ sư", "kỹ  sư", "Kế toán", None])) for i in range(30)]
        for _ in range(6)
    ]

    def merge(first, last):
        for number in range(first, last):
            write_chunk(inbox, number, chunks[number])
        merge_arrived(spark, str(inbox), CHUNK, "stt", out, state, files_per_batch=100)
        return sorted((r["_file"].rsplit("/", 1)[1], r["stt"]) for r in spark.read.parquet(out).collect())

    def expected(last):
        seen, kept = set(), []
        rows = [(n, *r) for n in range(last) for r in chunks[n]]
        keys = {r["_file"]: r["k"] for r in _keys(spark, rows)}
        for i, (n, stt, *_) in enumerate(rows):
            if keys[i] not in seen:
                seen.add(keys[i])
                kept.append((f"chunk-{n}.json", stt))
        return sorted(kept)

    assert merge(0, 3) == expected(3)
    assert merge(3, 3) == expected(3)  # nothing new
    # a run that was killed before its last batch was noted as done
    commits = os.path.join(state, "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    assert merge(3, 3) == expected(3)
    assert merge(3, 6) == expected(6)


def _keys(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_file long, n long, stt long, url string, `tên công việc` string")
    return df.select("_file", dedup.merge_key(df).alias("k")).collect()


def test_lost_attempts_leave_no_document(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([(1, "á"), (2, 'q"\n'), (None, "x")], "id long, s string")
    bulk.save_bulk(rows, path, "jobs", "id")
    (lost, _), *_ = filesets.listed(path, (".ndjson",))
    data = open(lost, "rb").read()
    with open(f"{path}/part-lost.ndjson", "wb") as other:  # of an attempt whose task ran again
        other.write(data)
    assert bulk.read_bulk(spark, path).count() == 3
    bulk.save_bulk(rows, path, "jobs", "id")  # the same load once more
    found = {r["id"]: (r["index"], json.loads(r["value"]).get("s")) for r in bulk.read_bulk(spark, path).collect()}
    assert len(found) == 3 and found["1"] == ("jobs", "á") and found["2"] == ("jobs", 'q"\n')
    lines = open(filesets.listed(path, (".ndjson",))[0][0], encoding="utf-8").read().splitlines()
    assert json.loads(lines[0])["index"]["_index"] == "jobs"
    with pytest.raises(Exception, match="value"):
        broken = spark.range(4).selectExpr("CAST(id AS STRING) AS id", "IF(id = 3, raise_error('value'), 'v') AS value")
        broken.write.format("bulk_index").option("index", "x").mode("overwrite").save(path)
    assert bulk.read_bulk(spark, path).count() == 3  # an aborted job changes nothing


def test_crawl_stops_on_either_rule(spark):
    pages = [("a", p, 5 if p == 1 else -1) for p in range(1, 9)] + [("b", p, -1) for p in range(1, 20)] + [("c", 1, 0), ("c", 2, 1)]
    links = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 3, "z"), ("a", 3, "w"), ("a", 5, "v"), ("a", 6, "u"), ("b", 2, "x"),
             ("b", 14, "q"), ("c", 2, "m"), ("c", 2, None)]
    got = ranking.crawl_progress(
        spark.createDataFrame(pages, "site string, page long, told long").repartition(4),
        spark.createDataFrame(links, "site string, page long, link string"),
        "site", "page", "link", "told",
    )
    rows = {(r["site"], r["page"]): r for r in got.collect()}
    stops = {s: min((p for (t, p), r in rows.items() if t == s and r["stops"]), default=None) for s in "abc"}
    assert stops == {"a": 5, "b": 13, "c": None}
    assert [rows["a", p]["found"] for p in range(1, 9)] == [2, 2, 4, 4, 5, 6, 6, 6] and rows["a", 7]["total"] == 5
    plain = ranking.page_streaks(got.select("site", "page", "new_count"), "site", "page", "new_count")
    assert plain.columns == ["site", "page", "new_count", "streak", "stops"]


FIELDS = st.tuples(st.text("abc", max_size=30), st.text("ab", max_size=4))


@settings(max_examples=300, deadline=None)
@given(FIELDS, FIELDS, st.booleans(), st.sampled_from([0.5, 0.8, 0.95]))
def test_lengths_never_keep_similar_names_apart(a, b, skip_empty, threshold):
    compare = entities.Comparison(threshold, skip_empty, 0)
    scores = [text_ratio(x, y) for x, y in zip(a, b) if not skip_empty or (x and y)]
    sizes = [tuple(map(len, t)) for t in (a, b)]
    groups = [entities.Group(["x"], 1, s, s) for s in sizes]
    if scores and sum(scores) / len(scores) >= threshold:
        assert entities.may_meet(*groups, compare) and entities.may_meet(*groups[::-1], compare)


def test_blocks_of_unlike_lengths_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(entities, "BLOCK", 16)
    draw = random.Random(2)
    texts = ["".join(draw.choice("abcd ") for _ in range(n)) for n in range(1, 120) for _ in range(3)]
    names = spark.createDataFrame([(i, [t], [t], []) for i, t in enumerate(texts)], "id long, early array<string>, late array<string>, agree array<string>")
    groups = entities.length_groups(names, "early")
    assert sum(g.names for g in groups) == len(texts) and all(g.names <= 16 or len(g.bands) == 1 for g in groups)
    compare = entities.Comparison(0.8, False, 0)
    met = entities.meetings(groups, groups, compare)
    assert len(groups) <= len(met) < len(groups) ** 2 / 2
    got = {(r["early_id"], r["late_id"]) for r in entities.meet(names, names, compare, every=True, first=True).collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if text_ratio(texts[j], texts[i]) >= 0.8}
    assert got == want
