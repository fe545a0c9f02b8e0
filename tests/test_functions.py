"""Gold cases of the scalar and array functions."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobweave.functions import experience, html, location, salary, schedule, similarity, terms, text, vocab


def test_clean_text(apply):
    got = apply(text.clean_text, ["  Kỹ sư  C++ (Hà Nội) #1 ", None, "", "a 　b\n\tc", "x_y & z/t; u!", "Ⅷ ½ 中文"])
    assert got == ["Kỹ sư C (Hà Nội) 1", "", "", "a b c", "x_y & z/t u", "Ⅷ ½ 中文"]
    decomposed = apply(lambda c: text.clean_text(c, "NFKD"), ["Kỹ sư"])
    assert decomposed == [unicodedata.normalize("NFKD", "Kỹ sư")]


def test_strip_matches_python(apply):
    values = ["  a b \x85", "\x1c\x1dx\x1e", "​z​", "  "]
    assert apply(text.strip, values) == [v.strip() for v in values]


def test_accents_and_signatures(apply):
    got = apply(text.strip_accents, ["Công ty TNHH Đà Nẵng", None, "Ａbc １２", "é", "Ünï-cödé!"])
    assert got == ["cong ty tnhh a nang", "", "abc 12", "e", "uni code"]
    assert apply(text.signature_tokens, ["CÔNG TY TNHH QR CONNECT", "QR  connect Co., Ltd", None]) == ["connect qr", "connect qr", ""]


def test_keys(spark):
    row = spark.createDataFrame([(" Kỹ  Sư ", None, "Hà Nội")], "t string, c string, l string")
    assert row.select(text.composite_key("t", "c", "l")).first()[0] == "kỹ sư____hà nội"
    assert len(row.select(text.block_key(F.col("l"), F.col("t"), F.col("c"))).first()[0]) == 64


def test_normal_forms(apply):
    values = ["Tiếng Việt", "ﬁ１", None]
    for form in ("NFC", "NFD", "NFKC", "NFKD"):
        got = apply(_form(form), values)
        assert got == [unicodedata.normalize(form, v) if v is not None else None for v in values]


def _form(form):
    return lambda c: text.normalize_unicode(c, form)


def test_locations(apply):
    values = ["Thanh Xuân, Hà Nội", "Toàn Quốc", "bà rịa-vũng tàu", None, "Thủ Đức, TP, Hồ Chí Minh"]
    assert apply(location.vietnamese_city, values) == ["Hà Nội", "Toàn Quốc", "bà rịa-vũng tàu", "", "Hồ Chí Minh"]
    assert apply(location.vietnamese_province, values) == ["Hà Nội", "", "", "", "Hồ Chí Minh"]
    assert apply(location.extract_location, values) == ["Hà Nội", None, "Bà Rịa-Vũng Tàu", None, "Hồ Chí Minh"]
    assert apply(location.extract_state, values) == ["Hà Nội", "", "", "", "TP"]
    assert len(location.CITIES) == len(location.PROVINCES) == 63 == len(set(location.CITIES))


SALARIES = [
    # text, dialect A, dialect B
    ("Thỏa thuận", (None, None), (None, None)),
    ("Upto 20 triệu VND", (20e6, 20e6), (20e6, 20e6)),
    ("8 - 15 triệu VNĐ", (8e6, 15e6), (8e6, 15e6)),
    ("Từ 8 triệu - 15++ triệu", (8e6, 15e6), (8e6, 15e6)),
    ("947 - 1137", (22_728_000.0, 27_288_000.0), (947.0, 1137.0)),
    ("Lên đến 27 Tr VND", (27e6, 27e6), (27e6, 27e6)),
    ("Từ 1,000 USD", (24e6, 24e6), (24_000.0, 24_000.0)),
    ("30.000.000 VND", (30e6, 30e6), (30e6, 30e6)),
    ("Từ 10 Triệu - Dưới 15 Triệu VNĐ / Tháng", (10e6, 10e6), (10e6, 10e6)),
    ("1,100 - 1,400 USD", (26.4e6, 33.6e6), (26_400.0, 33_600.0)),
    ("Tới 80 triệu", (80e6, 80e6), (80e6, 80e6)),
    ("3 trình", (None, None), (3e6, 3e6)),
    ("10 - 15 trđ", (10e6, 15e6), (10e6, 15e6)),
    ("500K to 800K", (500e3, 800e3), (500e3, 800e3)),
    ("10.000.000 - 15.000.000", (10e6, 15e6), (10e6, 15e6)),
    ("12,5 triệu", (12.5e6, 12.5e6), (12.5e6, 12.5e6)),
    ("5", (None, None), (None, None)),
    ("", (None, None), (None, None)),
    (None, (None, None), (None, None)),
]


def test_salary_dialects(apply):
    values = [s[0] for s in SALARIES]
    for fn, column in ((salary.salary_range_a, 1), (salary.salary_range_b, 2)):
        for case, got in zip(SALARIES, apply(fn, values)):
            assert tuple(got) == pytest.approx(case[column]), case[0]


def test_salary_rate_and_dollars(apply):
    assert apply(lambda c: salary.salary_range_a(c, 25_000.0), ["$1000"])[0]["min"] == 25e6
    got = apply(salary.dollar_range, ["$50K-$70K", "50,000 – 70,000.50", "from $99", "none", None])
    assert [tuple(g) for g in got] == [(50e3, 70e3), (50e3, 70000.5), (99.0, 99.0), (None, None), (None, None)]


def test_salary_bins(spark, apply):
    texts = {
        "Mức lương 10 - 15 triệu": [10, 15],
        "$1000": [20],
        "5 - 25 triệu": [5, 10, 15, 20, 25],
        "10 triệu đến 20 triệu": [10, 15, 20],
        "150 triệu": [100],
        "lương từ 20.000.000": [20],
        "1,000 USD": [20],
        "x": [],
        None: [],
    }
    assert apply(salary.salary_bins_from_text, list(texts)) == list(texts.values())
    cases = [
        (8e6, 15e6, "VND", [5, 10, 15]), (1000.0, 1400.0, "USD", [20, 25, 30]), (None, 120e6, "VND", [100]),
        (150e6, 200e6, "VND", []), (None, None, None, []), (15e6, 8e6, None, [5, 10, 15]), (7e6, 7e6, None, [5]),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, a double, b double, c string")
    bins = salary.salary_bins_from_numbers(F.col("a"), F.col("b"), F.col("c"))
    assert [r[0] for r in df.orderBy("i").select(bins).collect()] == [c[3] for c in cases]


def test_long_digit_run_is_fast(apply):
    assert apply(salary.salary_bins_from_text, ["1 " * 20_000 + "x"]) == [[]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(0, 60)), min_size=1, max_size=20))
def test_ordered_ranges_stay_ordered(apply, pairs):
    values = [f"{a} - {a + b} triệu" for a, b in pairs]
    for fn in (salary.salary_range_a, salary.salary_range_b):
        assert [tuple(x) for x in apply(fn, values)] == [(a * 1e6, (a + b) * 1e6) for a, b in pairs]


def test_experience(apply):
    values = ["1 - 2 năm", "0,2 năm", "Dưới 1 năm", "", "Không yêu cầu", None, "1 năm, 3 năm kinh nghiệm", "không  yêu   cầu", "3 đến 6 năm", "2n"]
    assert apply(experience.vietnamese_experience, values) == [1, 2, 1, None, 0, None, 3, 0, 4, 2]
    english = ["3-5 years", "5+ years of experience", "2 to 5 Years", "4 yrs exp", "7y", "none"]
    assert apply(experience.english_experience, english) == [4, 5, 3, 4, 7, None]


def test_integer_lists(apply):
    values = ["1 - 2 năm", "0,2 năm", "3 - 15 năm", "5 - 3 năm", "1, 2, 3", None, "7", "abc12 3"]
    assert apply(experience.experience_list, values) == [[1, 2], [0, 1, 2], list(range(3, 11)), [], [1, 2, 3], [], [7], [3]]
    assert apply(experience.age_list, ["25 - 38", "22 - 60", None]) == [[25, 30, 35], [20, 25, 30, 35, 40, 45], []]
    assert apply(experience.render_experience, [[3, 1, None], [2], [], None], "array<int>") == ["1 - 3 năm", "2 năm", None, None]


def test_schedule(apply):
    cases = {
        "Thứ 2 - Thứ 6 (từ 08:00 đến 17:30)": schedule.FULL_TIME,
        "Thứ 2, Thứ 4": schedule.PART_TIME,
        "Full  time": schedule.FULL_TIME,
        "Làm bán thời gian": schedule.PART_TIME,
        "8 giờ": schedule.FULL_TIME,
        "4 tiếng": schedule.PART_TIME,
        "Linh hoạt": schedule.PART_TIME,
        "": None,
        None: None,
    }
    assert apply(schedule.classify_work_schedule, list(cases)) == list(cases.values())


def test_vocabulary(spark, apply):
    row = spark.createDataFrame([("game AI Git digital", None, "internet ASP.NET Proooc", "TIẾNG ANH, English, tiếng trung")], "a string, b string, c string, d string")
    got = row.select(
        vocab.extract_knowledge("a", "b"), vocab.extract_frameworks("c", "b"),
        vocab.extract_programming_languages("c", "b"), vocab.extract_languages("d"),
    ).first()
    assert got[0] == ["game", " AI ", "Git"]
    assert got[1] == [".NET", "ASP.NET"]
    assert "Pro*C" in got[2]
    assert got[3] == ["Tiếng Anh", "Tiếng Anh", "tiếng trung"]
    assert apply(lambda c: vocab.vocab_match(c, ["Git"], word_boundary=True), ["digital", "dùng git."]) == [[], ["Git"]]
    assert apply(vocab.grouped_knowledge, [["game", "Git", "Word"], ["game"], None], "array<string>") == ["version_control", None, None]
    assert apply(vocab.extract_job_type, ["cntt - phần mềm; CNTT - Phần cứng / Mạng", None]) == [["software", "hardware"], []]
    assert apply(vocab.extract_education, [None, "Cử nhân"]) == [[], ["Cử nhân"]]


def test_vocabulary_tables(spark):
    assert vocab.label_table(spark).count() == len(terms.KNOWLEDGE_LABELS)
    assert vocab.group_table(spark).filter("category = 'office'").count() == 4


def naive_ratio(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    total = len(a) + len(b)
    return 1 - (total - 2 * rows[-1][-1]) / total if total else 1.0


@settings(max_examples=200, deadline=None)
@given(st.text("abcđ ", max_size=20), st.text("abcđ ", max_size=20))
def test_ratio_is_exact_and_symmetric(a, b):
    got = similarity.text_ratio(a, b)
    assert got == naive_ratio(a, b) == similarity.text_ratio(b, a)
    assert (got == 1) == (a == b)


def test_ratio_columns(spark):
    df = spark.createDataFrame([("google inc", "google"), ("abc", "abd"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(similarity.ratio("a", "b")).collect()]
    assert got[0] == 0.75 and got[1] == pytest.approx(2 / 3) and got[2] is None
    assert [r[0] for r in df.select(similarity.may_reach(F.col("a"), F.col("b"), 0.8)).collect()][:2] == [False, True]


def test_html_functions(apply, spark):
    assert apply(html.reported_total, ["x (1.234 việc) y", "(12 VIỆC)", "none", None]) == [1234, 12, -1, -1]
    url = "https://a.b/c?x=1&p=2#f"
    assert apply(lambda c: html.set_query_parameter(c, "p", "9"), [url, "https://a.b/c"]) == ["https://a.b/c?x=1&p=9#f", "https://a.b/c?p=9"]
    assert apply(html.url_path, [url, None]) == ["/c", ""]
    assert apply(lambda c: html.absolute_url(c, "https://h"), ["/a", "https://z", "b"]) == ["https://h/a", "https://z", "https://h/b"]
    assert apply(html.plain_text, ["<p>a<b>b</b><script>x</script><!-- c -->&amp; d</p>"]) == ["a b & d"]


def test_texts_are_normalised_in_pieces(spark, apply, monkeypatch):
    """F8: a whole batch of texts was held as Python objects; the texts stay the same."""
    values = ["é", None, "", "ấ", "a" * 10]
    whole = apply(lambda c: text.normalize_unicode(c, "NFC"), values)
    assert whole == ["é", None, "", "ấ", "a" * 10]
    pieces, array = [], text.pa.array
    monkeypatch.setattr(text, "HELD", 1)
    monkeypatch.setattr(text.pa, "array", lambda held, kind: pieces.append(len(held)) or array(held, kind))
    assert text.normalise(array(values), "NFC").to_pylist() == whole
    assert max(pieces) <= 3 and sum(pieces) == 5
