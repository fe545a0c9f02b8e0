"""Readers, sinks, cleaners, duplicates, entities, quality and schema matching."""

import json
import random

import pytest
from pyspark.sql import functions as F

from jobweave.functions import text
from jobweave.functions.similarity import text_ratio
from jobweave.operators import aggregates, clean, dedup, entities, matching, pages, quality, ranking, schema_match
from jobweave.plans import extract, jobs
from jobweave.sources import readers, schemas, sinks


def write(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


POSTING = {
    "stt": 1, "ten_cong_viec": "Kỹ sư  Java!", "ten_cong_ty": "Công ty A", "dia_diem_lam_viec": "Thanh Xuân, Hà Nội",
    "muc_luong": "8 - 15 triệu VNĐ", "kinh_nghiem": "1 - 2 năm", "mo_ta_chi_tiet": "Làm việc với Git", "ki_nang_yeu_cau": "Tiếng Anh",
    "loai_cong_viec": "Toàn thời gian", "cap_bac": "Quản lý", "quy_mo": "50", "han_nop": "18/11/2025",
    "nganh_nghe": "CNTT - Phần mềm", "link": "https://x/1",
}


# --- sources and sinks -----------------------------------------------------------------------------------------------


def test_load_json_tolerates_bad_input(spark, tmp_path):
    good = write(tmp_path / "good.json", [POSTING, POSTING | {"stt": "2"}])
    (tmp_path / "broken.json").write_text("[{", encoding="utf-8")
    assert readers.load_json(spark, good, schemas.JOBOKO).count() == 2
    assert readers.load_json(spark, str(tmp_path / "missing.json"), schemas.JOBOKO).count() == 0
    assert readers.load_json(spark, str(tmp_path / "broken.json"), schemas.JOBOKO).count() == 0
    assert readers.load_json(spark, write(tmp_path / "empty.json", []), schemas.JOBOKO).count() == 0


def test_load_csv_with_mark_and_line_breaks(spark, tmp_path):
    path = tmp_path / "links.csv"
    path.write_text('﻿stt,tên việc,link\n1,"a ""b""\nc",https://x\n2,d,https://y\n', encoding="utf-8")
    rows = readers.load_csv(spark, str(path), schemas.LINK_CSV).orderBy("stt").collect()
    assert [tuple(r) for r in rows] == [(1, 'a "b"\nc', "https://x"), (2, "d", "https://y")]


def test_load_all_sources_and_profile(spark, tmp_path):
    frames = readers.load_all_sources(spark, {"joboko": write(tmp_path / "j.json", [POSTING]), "topcv": str(tmp_path / "no"), "careerlink": str(tmp_path / "no")})
    assert {s: df.count() for s, df in frames.items()} == {"careerlink": 0, "joboko": 1, "topcv": 0}
    profile = readers.source_profile(frames)
    assert profile.filter("source = 'topcv' AND rows <> 0").count() == 0
    assert profile.filter("source = 'joboko' AND column = 'link'").first()["chars"] == len(POSTING["link"])


def test_chunks_skip_objects_and_broken_files(spark, tmp_path):
    a = {"Liên_kết": "u1", "tên công việc": "A", "công ty": "C", "địa điểm làm việc": "H"}
    write(tmp_path / "data1.json", [a, a | {"Liên_kết": ""}, a | {"Liên_kết": None}])
    write(tmp_path / "data2.json", [a | {"tên công việc": "later"}, a | {"Liên_kết": "u2"}])
    write(tmp_path / "data3.json", a | {"Liên_kết": "object"})
    (tmp_path / "data4.json").write_text("nope", encoding="utf-8")
    write(tmp_path / "data_out.json", [a | {"Liên_kết": "own output"}])
    schema = schemas._strings("Liên_kết", "tên công việc", "công ty", "địa điểm làm việc")
    chunks = readers.read_chunks(spark, str(tmp_path / "data*.json"), schema, exclude=["data_out.json"])
    assert chunks.count() == 5
    merged = dedup.merge_chunks(chunks, number="stt").orderBy("stt").collect()
    assert [(r["stt"], r["Liên_kết"], r["tên công việc"]) for r in merged] == [(1, "u1", "A"), (2, "", "A"), (3, "u2", "A")]
    again = dedup.merge_chunks(dedup.merge_chunks(chunks), number="stt")
    assert again.count() == 3


def test_merge_key_without_link(spark):
    df = spark.createDataFrame([("A ", "c", "H"), ("a", "C", "h")], "`tên công việc` string, `công ty` string, `địa điểm` string")
    assert df.select(dedup.merge_key(df)).distinct().count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "đ"), (2, None)], "stt int, ten string")
    out = str(tmp_path)
    paths = sinks.save_frames([df, df], ["a", "b"], out)
    assert [spark.read.json(p).count() for p in paths] == [2, 2]
    sinks.save_index([df], ["recruit"], root=out)
    assert spark.read.json(f"{out}/recruit").count() == 2
    docs = [r[0] for r in spark.read.text(sinks.save_documents(df, f"{out}/docs")).collect()]
    assert sorted(json.loads(d)["stt"] for d in docs) == [1, 2]
    csv = sinks.export_csv(df, f"{out}/csv", single_file=True, bom=True)
    assert spark.read.option("header", True).csv(csv).columns == ["stt", "ten"]
    from datetime import datetime

    at = datetime(2025, 11, 2, 3, 4, 5)
    assert sinks.export_records(df, out, at).endswith("export-20251102_030405.json")
    assert sinks.export_report(df, out, at).endswith("matching_report_20251102_030405.json")
    assert spark.read.json(sinks.save_single(df, f"{out}/one")).count() == 2
    assert sinks.first_rows(df, "stt", 1).count() == 1 and sinks.first_rows(df, "stt").count() == 2


def test_tagged_and_typed_reads(spark, tmp_path):
    one, two = write(tmp_path / "1.json", [{"source": "x"}]), write(tmp_path / "2.json", [{"source": "y"}])
    tagged = readers.read_tagged(spark, {"s1": one, "s2": two}, schemas.FEATURE_INPUT)
    assert {(r["_src"], r["source"]) for r in tagged.collect()} == {("s1", "x"), ("s2", "y")}
    typed = write(tmp_path / "t.json", [{"id": 1, "skills": ["Git"], "salary_min": 8000000, "salary_max": 15000000, "salary_currency": "VND", "job_description": "Docker"}])
    row = extract.extract_typed_features(readers.read_typed(spark, typed, lines=False)).first()
    assert row["Knowledges"] == ["Git"] and row["Salaries"] == [5, 10, 15] and row["FrameworkPlattforms"] == ["Docker", "Git"]


# --- cleaning ------------------------------------------------------------------------------------------------------------


def joboko(spark, *changes):
    rows = [POSTING | c for c in changes or ({},)]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.JOBOKO) for r in rows], schemas.JOBOKO)


def test_clean_joboko(spark):
    row = clean.clean_source(joboko(spark), "joboko").first()
    assert (row["source"], row["job_title_clean"], row["city"], row["state"], row["country"]) == ("joboko", "Kỹ sư Java", "Hà Nội", "Hà Nội", "Vietnam")
    assert (row["salary_min"], row["salary_max"], row["experience"]) == (8e6, 15e6, 1)
    assert row["education"] is None and row["benefits"] == "" and "company_size" not in row
    assert clean.clean_source(joboko(spark), "joboko", extended=True).first()["company_size"] == "50"
    standard = clean.standardize(clean.clean_source(joboko(spark), "joboko"))
    assert standard.columns == schemas.STANDARD_COLUMNS


def test_clean_topcv_and_unknown(spark):
    raw = spark.createDataFrame([("A", "B", "H", "10 triệu", "2 năm")], "`tên công việc` string, `công ty` string, `địa điểm làm việc` string, `lương` string, `yêu cầu kinh nghiệm` string")
    row = clean.clean_source(raw, "topcv").first()
    assert row["experience"] is None and row["industry"] is None and row["skills"] == "" and row["work_time"] is None
    assert clean.clean_source(raw, "topcv", extended=True).first()["experience"] == 2
    assert clean.clean_source(raw, "elsewhere") is raw


def test_careerlink_without_salary_column(spark):
    raw = spark.createDataFrame([("A",)], "`tên công việc` string")
    cleaned = clean.clean_source(raw, "careerlink")
    assert "salary_min" not in cleaned.columns and "location_clean" not in cleaned.columns
    assert clean.standardize(cleaned).first()["salary_text"] is None


def test_key_columns():
    assert clean.key_columns(["company_name", "x"]) == ["company_name"]
    assert clean.key_columns(["Job Title", "Organization", "Location"]) == ["Job Title", "Location"]
    assert clean.key_columns(["x"]) == []


# --- duplicates and numbering ----------------------------------------------------------------------------------------------


def test_find_duplicates_null_and_blank(spark):
    rows = [(1, "a", "", "c"), (2, "a", "", "c"), (3, None, "b", "c"), (4, None, "b", "c"), (5, "z", "z", "z"), (6, "0", "1", "2"), (7, "0", "1", "2")]
    df = spark.createDataFrame(rows, "id int, job_title_clean string, company_name string, location_clean string")
    got = {r["id"]: (r["is_duplicate"], r["duplicate_group"]) for r in dedup.find_duplicates(df).collect()}
    assert got == {1: (True, 1), 2: (True, 1), 3: (False, None), 4: (False, None), 5: (False, None), 6: (True, 0), 7: (True, 0)}


def test_find_duplicates_single_key_and_hot_key(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k")
    marked = dedup.find_duplicates(df, ["k"])
    assert marked.filter("is_duplicate").count() == 1000 and marked.count() == 3000


def test_lookup_counts_its_own_keys(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "id")
    values = spark.range(4000).selectExpr("id AS k", "id * 2 AS v")
    got = ranking.lookup(df, values, ["k"])
    want = df.join(values, "k", "left")
    assert got.count() == want.count() == 5000
    assert got.exceptAll(want.select(got.columns)).isEmpty()


def test_renumber_many_partitions(spark):
    df = spark.range(10_000).repartition(16).withColumn("v", F.hash("id"))
    got = ranking.renumber(df, "v", "id").orderBy("v", "id").select("stt").collect()
    assert [r[0] for r in got] == list(range(1, 10_001))


def test_page_streaks_across_partitions(spark):
    random.seed(1)
    news = [random.choice([0, 0, 0, 1]) for _ in range(3000)]
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate(news)] + [("t", i, 0) for i in range(15)], "site string, page int, news int").repartition(8)
    rows = ranking.page_streaks(df, "site", "page", "news").orderBy("site", "page").collect()
    streak, want = 0, []
    for n in news:
        streak = 0 if n else streak + 1
        want.append(streak)
    assert [r["streak"] for r in rows if r["site"] == "s"] == want
    assert [r["stops"] for r in rows if r["site"] == "t"] == [False] * 10 + [True] * 5


def test_block_and_merge(spark):
    rows = [
        ("Kỹ sư Java", "Công ty TNHH QR", "Hà Nội", "", "ngắn"),
        ("JAVA kỹ sư", "QR", "hà nội", "1 - 3 năm", "mô tả dài hơn"),
        ("Khác", None, "Huế", None, "x"),
    ]
    df = spark.createDataFrame(rows, "t string, c string, l string, e string, d string")
    merged = dedup.block_and_merge(df, "t", "c", "l", "e", ["t", "c", "l", "e", "d"]).orderBy("stt").collect()
    assert len(merged) == 2
    first = next(r for r in merged if r["block_size"] == 2)
    assert (first["c"], first["e"], first["d"], first["experience_years"]) == ("Công ty TNHH QR", "1 - 3 năm", "mô tả dài hơn", [1, 2, 3])
    other = next(r for r in merged if r["block_size"] == 1)
    assert other["e"] is None and other["c"] == ""


# --- fuzzy matching ---------------------------------------------------------------------------------------------------------


def greedy(names, score, threshold=0.8, first=False):
    """The sequential rule, written out plainly."""
    leaders, mapping = [], {}
    for i, name in enumerate(names):
        best, best_score = None, 0.0
        for leader in leaders:
            value = score(name, names[leader])
            if value >= threshold and value > best_score and not (first and best is not None):
                best, best_score = leader, value
        if best is None:
            leaders.append(i)
            best = i
        mapping[i] = best
    return mapping


def noisy_names(seed, n_base, copies):
    random.seed(seed)
    names = []
    for _ in range(n_base):
        base = "".join(random.choice("abcdeghđ ") for _ in range(random.randint(1, 16)))
        for _ in range(copies):
            letters = list(base)
            for _ in range(random.randint(0, 3)):
                if letters and random.random() < 0.5:
                    letters.pop(random.randrange(len(letters)))
                else:
                    letters.insert(random.randint(0, len(letters)), random.choice("abcdeghđ "))
            names.append("".join(letters))
    names += [f"Company#{i:06d}" for i in range(60)]
    random.shuffle(names)
    return list(dict.fromkeys(n for n in names if n))


@pytest.mark.parametrize("front,block", [(4096, 1024), (3, 7)])
def test_entity_mapping_equals_the_sequential_rule(spark, monkeypatch, front, block):
    monkeypatch.setattr(entities, "FRONT", front)
    monkeypatch.setattr(entities, "BLOCK", block)
    names = noisy_names(5, 30, 5)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "row long, name string")
    got = {r["name"]: r["canonical"] for r in entities.entity_mapping(df, "name", "row").collect()}
    want = greedy(names, lambda a, b: text_ratio(a.lower().strip(), b.lower()))
    assert got == {names[i]: names[leader] for i, leader in want.items()}


def test_letter_counts_bound_the_ratio():
    names = noisy_names(9, 25, 5)
    texts = entities.Texts([[n] for n in names], [None] * len(names))
    compare = entities.Comparison(0.8, False, 0)
    for j in range(len(names)):
        possible = compare.possible(texts, texts, j)
        assert all(possible[i] for i in range(len(names)) if text_ratio(names[i], names[j]) >= 0.8)


@pytest.mark.parametrize("blocked", [False, True])
def test_similar_records_equal_the_sequential_rule(spark, blocked):
    random.seed(4)
    fields = ["job_title_clean", "company_name", "location_clean"]
    rows = []
    for i in range(300):
        title = random.choice(["java developer", "java developers", "Kế toán", "data analyst", "data analysts 2"])
        company = random.choice(["Alpha", "Alpha Co", "Beta", "", None])
        rows.append((i, title, company, random.choice(["Hà Nội", "Huế", "Đà Nẵng"])))
    df = spark.createDataFrame(rows, "id long, job_title_clean string, company_name string, location_clean string")
    groups = entities.similar_records(df, "id", fields, agreeing=2 if blocked else 0)
    distinct = {}
    for i, *values in rows:
        distinct.setdefault(tuple((v or "").lower() for v in values), i)
    records = list(distinct)

    def folded(value):
        from unicodedata import combining, normalize

        return "".join(c for c in normalize("NFKD", value) if not combining(c))

    def score(a, b):
        met = sum(1 for x, y in zip(a, b) if x and folded(x) == folded(y))
        scores = [text_ratio(x, y) for x, y in zip(a, b) if x and y]
        return sum(scores) / len(scores) if scores and (met >= 2 or not blocked) else 0.0

    want = greedy(records, score, first=True)
    got = {r["id"]: r["leader"] for r in groups.collect()}
    assert got == {distinct[records[i]]: distinct[records[leader]] for i, leader in want.items()}
    rows_with_group = entities.similar_rows(df, groups, "id", fields)
    assert rows_with_group.count() == 300 and rows_with_group.filter("leader IS NULL").count() == 0


def test_matching_report(spark):
    rows = [(i, "java dev", "Alpha", "Huế") for i in range(6)] + [(6, "kế toán", "Beta", "Hà Nội"), (7, "java devs", "Alpha", "Huế")]
    df = spark.createDataFrame(rows, "id long, job_title_clean string, company_name string, location_clean string")
    result = matching.matching_report(df, "id")
    report = result.report.first()
    assert (report["total_records"], report["duplicate_count"], report["duplicate_groups"]) == (8, 6, 1)
    assert (report["similar_groups"], report["similar_records"], report["canonical_job_titles"]) == (1, 7, 2)
    assert matching.ADVICE_DUPLICATES in report["recommendations"] and matching.ADVICE_SIMILARITY in report["recommendations"]
    assert result.duplicates.filter("is_duplicate").count() == 6


# --- quality and schemas -------------------------------------------------------------------------------------------------------


def test_quality_score(spark):
    df = spark.createDataFrame(
        [("10", "5", 3, None), ("x", "9", 70, "c"), (None, None, None, "c"), ("1", "2", 1, "c")],
        "salary_min string, salary_max string, experience int, company_name string",
    )
    found = {r["rule"]: r["records"] for r in quality.validate(df).collect()}
    assert found == {"salary_min_above_max": 1, "unrealistic_experience": 1, "missing_company_name": 1, "non_numeric_salary_min": 2}
    row = quality.quality(df).first()
    assert (row["missing_cells"], row["errors"], row["warnings"]) == (4, 2, 2)
    assert row["quality_score"] == 75.0 - 10 - 4
    assert quality.quality(df.limit(0)).first()["quality_score"] == 0.0


def test_schema_matching(spark):
    frames = {
        "careerlink": spark.createDataFrame([("a", "b", 1)], "`tên công việc` string, `Mức lương` string, x int"),
        "joboko": spark.createDataFrame([("a", "b")], "`tên công viêc` string, `mức lương` string"),
        "topcv": spark.createDataFrame([], "`tên công việc` string"),
    }
    result = schema_match.analyze(frames)
    mapped = {(r["source"], r["field"]): r["column"] for r in result["mapping"].collect()}
    assert mapped == {
        ("careerlink", "job_title"): "tên công việc", ("careerlink", "salary"): "Mức lương",
        ("joboko", "job_title"): "tên công viêc", ("joboko", "salary"): "mức lương",
    }
    fields = {r["field"]: r for r in result["fields"].collect()}
    assert fields["salary"]["is_common"] and fields["salary"]["consistency_score"] == 1.0
    assert result["overall"].first()["overall_compatibility"] == 1.0
    unknown = {"elsewhere": frames["careerlink"]}
    assert schema_match.analyze(unknown)["overall"].first()["overall_compatibility"] == 0.0


def test_counts(spark):
    df = spark.createDataFrame([(["Git", "Word"],), (["Git"],), ([],)], "k array<string>")
    counts = aggregates.term_counts(df, "k")
    assert [(r["term"], r["count"]) for r in counts.collect()] == [("Git", 2), ("Word", 1)]
    assert {r["category"]: r["count"] for r in aggregates.category_counts(counts).collect()} == {"version_control": 2, "office": 1}
    assert aggregates.with_salary(df, "k").count() == 2


# --- whole jobs ------------------------------------------------------------------------------------------------------------------


def test_integrate_and_feature_job(spark, tmp_path):
    source = write(tmp_path / "joboko.json", [POSTING, POSTING | {"link": "https://x/2"}, POSTING | {"ten_cong_viec": "Kế toán"}])
    paths = {"joboko": source, "topcv": str(tmp_path / "none"), "careerlink": str(tmp_path / "none")}
    out = str(tmp_path / "out")
    written = jobs.integrate(spark, out, paths)
    assert spark.read.json(written["records"]).count() == 3
    assert spark.read.json(written["report"]).first()["duplicate_count"] == 2
    summary = spark.read.json(written["summary"]).first()
    assert summary["statistics"]["total_processed_records"] == 3 and summary["statistics"]["unique_companies"] == 1
    assert summary["data_sources"]["joboko"]["raw_records"] == 3

    features = jobs.feature_job(spark, written["records"], out)
    rows = spark.read.json(features[0])
    row = rows.filter("title = 'Kỹ sư Java'").first()
    assert rows.count() == 3 and row["salary_avg"] == 11.5e6 and row["Knowledges"] == ["Git"] and row["Experience"] == [1, 2]
    assert (row["location_area"], row["province"], row["JobSummary"]) == ("Thanh Xuân", "Hà Nội", ["software"])
    assert spark.read.json(f"{out}/index/recruit").count() == 3
    assert len(extract.extract_features(readers.read_standard(spark, written["records"])).columns) == 24


def test_export_is_read_back_whole(spark, tmp_path):
    """Several files, one record per line; an array on request."""
    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS source", "'t\\nx' AS job_title_clean").repartition(2)
    path = sinks.export_records(rows, str(tmp_path))
    back = readers.read_standard(spark, path)
    assert back.count() == 1000 and back.select("source").distinct().count() == 1000
    assert back.first()["job_title_clean"] == "t\nx"
    array = write(tmp_path / "array.json", [{"source": "x"}, {"source": "y"}])
    assert readers.read_standard(spark, array, lines=False).count() == 2


def test_first_seen_follows_the_files(spark, tmp_path):
    """The same leaders and survivors for one, two and twenty files of mixed size."""
    rows = [POSTING | {"ten_cong_viec": f"{POSTING['ten_cong_viec']} {'abc'[i % 3]}", "link": f"https://x/{i}"} for i in range(40)]
    rows[0] = POSTING | {"ten_cong_viec": POSTING["ten_cong_viec"] + " z"}
    found = []
    for cuts in ([0], [0, 1], list(range(0, 40, 2))):
        folder = tmp_path / f"in{len(cuts)}"
        folder.mkdir()
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], 40])):
            write(folder / f"part{k:02d}.json", rows[a:b])
        placed = readers.load_all_sources(
            spark, {"joboko": f"{folder}/*.json", "topcv": "/none", "careerlink": "/none"}, placed=True
        )["joboko"]
        first = ranking.keep_first(placed, ["ten_cong_ty"], readers.PLACE)
        numbered = ranking.renumber(placed, *readers.PLACE, name="n")
        names = entities.entity_mapping(numbered, "ten_cong_viec", "n")
        found.append((first.first()["ten_cong_viec"], sorted((r["name"], r["canonical"]) for r in names.collect())))
    assert found[0] == found[1] == found[2] and found[0][0].endswith(" z")


def test_merge_key_ignores_the_unicode_form(spark):
    import unicodedata

    texts = ["Hà Nội", "Kỹ sư", "Å", "plain"]
    df = spark.createDataFrame([(unicodedata.normalize(f, t),) for t in texts for f in ("NFC", "NFD")], "t string")
    keys = df.select(text.composite_key(F.col("t"), F.col("t"), F.lit("x")).alias("k")).distinct()
    assert keys.count() == len(texts)


def test_pages_stored_twice_count_once(spark):
    links = spark.createDataFrame([(1, "a", "u1"), (2, "b", "u2")], "stt int, ten string, link string")
    page = '<h4 class="nw-job-detail__heading">Quy mô công ty</h4><div class="nw-job-detail__text">5</div>'
    stored = [("u1", page, 2), ("u1", "<p>old</p>", 3), ("u1", page, 2), (None, page, 1)]
    rows = pages.joboko_details(links, spark.createDataFrame(stored, "url string, html string, at int"), order=["at"]).collect()
    assert sorted((r["stt"], r["quy_mo"]) for r in rows) == [(1, "5"), (2, "")]


def test_schema_description(spark):
    frames = {"joboko": spark.createDataFrame([(1, None, "b"), (2, "x", "c")], "id int, muc_luong string, unknown string")}
    rows = {r["column"]: r for r in schema_match.describe_schema(frames, "id").collect()}
    assert rows["muc_luong"]["samples"] == ["x"] and rows["unknown"]["samples"] == ["b", "c"] and rows["unknown"]["field"] is None
    standard = schema_match.analyze(frames)["standard"]
    assert standard.count() == 12 and {r["declared_type"] for r in standard.collect()} == {"string", "numeric"}


def test_blocks_meet_in_many_tasks(spark):
    """adaptive execution joined all pairs of blocks in one task, for the rows are few bytes."""
    names = spark.range(5000).select("id", F.array(F.concat(F.lit("name"), "id")).alias("early"))
    names = names.select("id", "early", F.col("early").alias("late"), F.array().cast("array<string>").alias("agree"))
    met = entities.meet(names.where("id < 8"), names, entities.Comparison(0.8, False, 0), every=True, first=True)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan


def test_only_names_that_agree_are_compared(monkeypatch):
    """the letters of all names of two blocks were compared, though few names agree."""
    rows = [["ring a", "x"], ["ring b", "x"], ["ring a", ""], ["ring a", "x"]]
    early = entities.Texts(rows, [["r", "x"], ["r", "x"], ["r", ""], None])
    late = entities.Texts([["ring a", "x"]], [["r", "x"]])
    compare, seen = entities.Comparison(0.8, True, 2), []
    reaches = entities.Comparison._reaches
    monkeypatch.setattr(entities.Comparison, "_reaches", lambda self, sizes, *rest: seen.append(len(sizes)) or reaches(self, sizes, *rest))
    assert compare.possible(early, late, 0).tolist() == [True, True, False, False]
    assert seen == [2]
