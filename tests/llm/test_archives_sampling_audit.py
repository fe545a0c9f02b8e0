"""WARC archives, importance resampling and the filter audit against plain Python."""

import base64
import gzip
import hashlib
import io
import math
import os
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobweave.llm import audit, resampling, warc
from jobweave.sources import filesets

LONG = "dài và to " * 40_000
PAGES = [
    (7, "http://a/7", "<p>một</p>"),
    (3, "http://a/3", "<p>một</p>"),
    (5, "http://a/5\r\nX: y", "<p>một</p>"),
    (4, None, "<p>hai</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (8, "", None),
    (9, "u", ""),
    (10, "u", LONG),
    (11, "u", LONG),
    (3, "again", "<p>một</p>"),
    (None, "n", "<p>một</p>"),
    (None, "n", "alone"),
    (12, "u", "single"),
]


def expected_records(pages, least_bytes=0):
    smallest = {}
    for page_id, _, html in pages:
        if page_id is not None:
            smallest[html or ""] = min(page_id, smallest.get(html or "", page_id))
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        first = smallest.get(html or "") if len(data) >= least_bytes else None
        revisit = first is not None and (page_id is None or first < page_id)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def as_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least_bytes", [0, 8])
def test_archive_round_trip(spark, tmp_path, least_bytes):
    pages = spark.createDataFrame([(*p, "x", b"y") for p in PAGES], "page_id long, url string, html string, _least string, payload binary")
    warc.write_pages(pages, str(tmp_path), least_bytes)
    assert as_rows(warc.archived_pages(spark, str(tmp_path)), *RECORD) == expected_records(PAGES, least_bytes)
    # the files are WARC to a reader that knows nothing of this module
    seen = []
    for path, _ in filesets.listed(str(tmp_path), warc.SUFFIXES):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            http, _, payload = rest[:size].partition(b"\r\n\r\n")
            assert rest[size : size + 4] == b"\r\n\r\n" and http.startswith(b"HTTP/1.1 200")
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            else:
                assert payload == b"" and fields["WARC-Refers-To"].startswith("<urn:uuid:") and "WARC-Profile" in fields
            seen.append(fields["WARC-Type"])
            data = rest[size + 4 :]
    assert Counter(seen) == Counter(r[3] for r in expected_records(PAGES, least_bytes))


def test_archive_of_a_hot_payload(spark, tmp_path):
    """More copies than any share a key may have before it counts as hot."""
    pages = [(i, "u", "same" if i % 3 else f"page {i // 2}") for i in range(3000, 0, -1)]
    warc.write_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6), str(tmp_path))
    assert as_rows(warc.archived_pages(spark, str(tmp_path)), *RECORD) == expected_records(pages)


def test_archive_of_nothing(spark, tmp_path):
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path))
    assert warc.archived_pages(spark, str(tmp_path)).collect() == []


RECORDS = [
    b"WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 3\r\n\r\nabc",
    b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\n  folded\r\nWARC-Record-ID: <urn:1>\r\n"
    b"Content-Type: application/http\r\nContent-Length: 30\r\nPage-Id: 12\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\x01\x02\x03",
    b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: http://b/\r\nContent-Length: 0\r\nPage-Id: x\r\n\r\n",
]
SCHEMA = "record_type string, target_uri string, record_id string, content_length long, page_id long, payload binary, payload_bytes long"


def stored_forms():
    plain = b"".join(r + b"\r\n\r\n" for r in RECORDS)
    return {
        "a.warc": plain,
        "b.warc.gz": b"".join(gzip.compress(r + b"\r\n\r\n") for r in RECORDS),
        "c.warc.gz": gzip.compress(plain),
        "d.warc.gz": b"".join(warc.gzip_member(r + b"\r\n\r\n", 6) for r in RECORDS),
    }


def test_every_stored_form_reads_alike(spark, tmp_path):
    for name, data in stored_forms().items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "_left.warc").write_bytes(b"junk")
    (tmp_path / "other.txt").write_bytes(b"junk")
    wanted = [
        ("warcinfo", None, None, 3, None, b"abc", 3),
        ("response", "http://a/ folded", "<urn:1>", 30, 12, b"\x00\xff\x01\x02\x03", 5),
        ("resource", "http://b/", None, 0, None, b"", 0),
    ]
    df = warc.read_warc(spark, str(tmp_path), SCHEMA)
    rows = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect()]
    assert sorted(rows, key=str) == sorted(wanted * 4, key=str)
    one = warc.read_warc(spark, str(tmp_path / "a.warc"))
    assert one.count() == 3 and one.where("record_type = 'response'").first()["headers"]["page-id"] == "12"


PREDICATES = [
    "record_type = 'response'",
    "record_type != 'response'",
    "record_type IN ('warcinfo', 'resource')",
    "NOT (record_type IN ('warcinfo', 'resource'))",
    "target_uri LIKE 'http://a%' AND page_id > 3",
    "target_uri LIKE '%/' ",
    "target_uri LIKE '%old%'",
    "page_id IS NULL AND record_type >= 'response'",
    "page_id <=> NULL",
    "record_id IS NOT NULL OR payload_bytes = 3",
    "payload_bytes >= 3 AND content_length <= 30",
    "page_id < 13 AND record_id <= '<urn:2>'",
]


@pytest.mark.parametrize("predicate", PREDICATES)
def test_pushed_predicates(spark, tmp_path, predicate):
    for name, data in stored_forms().items():
        (tmp_path / name).write_bytes(data)
    df = warc.read_warc(spark, str(tmp_path), SCHEMA)
    every = spark.createDataFrame(df.collect(), df.schema)
    assert as_rows(df.where(predicate), "record_type", "target_uri", "page_id") == as_rows(
        every.where(predicate), "record_type", "target_uri", "page_id"
    )


def test_unwanted_payloads_stay_packed():
    """A damaged payload does not matter to a reader that does not want it."""
    long = RECORDS[0].replace(b"Content-Length: 3\r\n\r\nabc", b"Content-Length: 200000\r\n\r\n" + os.urandom(200_000))
    member = bytearray(warc.gzip_member(long + b"\r\n\r\n", 1))
    member[100_000:150_000] = bytes(50_000)
    data = bytes(member) + warc.gzip_member(RECORDS[1] + b"\r\n\r\n", 1)

    def read(wanted):
        return list(warc.read_records(io.BufferedReader(io.BytesIO(data)), wanted, True, True))

    found = read(lambda h: h["warc-type"] == "response")
    assert [p.data for _, p in found] == [b"\x00\xff\x01\x02\x03"]
    with pytest.raises(zlib.error):
        read(lambda h: True)
    with pytest.raises(EOFError):
        cut = io.BufferedReader(io.BytesIO(warc.gzip_member(long + b"\r\n\r\n", 1)[:-5000]))
        list(warc.read_records(cut, lambda h: True, True, False))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BufferedReader(io.BytesIO(b"junk\r\n")), lambda h: True, True, False))


def test_only_committed_files_count(spark, tmp_path):
    df = spark.createDataFrame([("resource", b"one")], "record_type string, payload binary")
    warc.register(spark)
    df.write.format("warc").mode("append").save(str(tmp_path))
    (tmp_path / "part-lost.warc.gz").write_bytes(stored_forms()["b.warc.gz"])
    assert warc.read_warc(spark, str(tmp_path)).count() == 1
    df.write.format("warc").mode("append").save(str(tmp_path))
    assert warc.read_warc(spark, str(tmp_path)).count() == 2
    df.write.format("warc").mode("overwrite").save(str(tmp_path))
    assert warc.read_warc(spark, str(tmp_path)).count() == 1


def test_files_are_packed_whole():
    files = [(f"f{i}", s) for i, s in enumerate([5, 5, 5, 40, 1, 1, 9])]
    parts = filesets.packed(files, 10)
    assert [p for part in parts for p in part] == [f for f, _ in files]
    assert parts == [["f0", "f1"], ["f2"], ["f3"], ["f4", "f5"], ["f6"]] and filesets.packed([], 10) == []


# --- importance resampling ----------------------------------------------------------------------------------------------

SHORT = "Alpha beta, GAMMA. "
DOCS = [
    (1, SHORT * 8),
    (2, SHORT * 8),
    (2, SHORT * 8),
    (3, "ÀÉ Đông x1 x2 " * 6),
    (4, None),
    (5, ""),
    (6, "few words"),
    (None, SHORT * 8),
    (7, " ".join(f"w{i}" for i in range(3000))),
    (8, "y" * 100_000 + " " + SHORT * 9),
    (9, "b a n c h m a r k" * 5),
    *[(100 + i, f"{SHORT} t{i} " * 7) for i in range(30)],
]
TARGET = [(1, "gamma x1 x2 alpha"), (2, None), (3, "t7 t8 gamma beta x1 x2")]


def brute_resample(docs, target, s):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [" ".join(words[i : i + n]) for n in range(1, s.most_words + 1) for i in range(len(words) - n + 1)]

    def buckets(texts):
        return Counter(zlib.crc32(f.encode()) % s.buckets for t in texts for f in features(t)[1])

    own, other = buckets(t for _, t in docs), buckets(t for _, t in target)
    s_all, t_all = sum(own.values()), sum(other.values())
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text)
        weight = 0
        for f in found:
            b = zlib.crc32(f.encode()) % s.buckets
            weight += math.floor(1000 * math.log((other[b] + 1) * (s_all + s.buckets) / ((own[b] + 1) * (t_all + s.buckets))))
        h = int(hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n_words])
    able = sorted((r for r in rows if r[5] >= s.least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    for place, row in enumerate(able[: s.percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


SAMPLE = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("most_words, buckets, percent", [(1, 10_000, 10), (2, 97, 40), (3, 5000, 100)])
@pytest.mark.parametrize("entries", [16384, 3])
def test_resampling(spark, monkeypatch, most_words, buckets, percent, entries):
    """Equal to brute force, whatever share of the features the head holds."""
    monkeypatch.setattr(resampling, "HEAD_ENTRIES", entries)
    s = resampling.Settings(most_words=most_words, buckets=buckets, percent=percent)
    docs = spark.createDataFrame([(*d, 1, "x") for d in DOCS], "doc_id long, text string, weight int, rank string").repartition(3)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    assert as_rows(resampling.resample(docs, target, s), *SAMPLE) == brute_resample(DOCS, TARGET, s)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    assert resampling.resample(none, target).collect() == []
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    s = resampling.Settings()
    assert as_rows(resampling.resample(docs, target.limit(0)), *SAMPLE) == brute_resample(DOCS, [], s)


def test_tail_continues_from_head_states():
    s = resampling.Settings(most_words=3, buckets=1 << 20)
    head = resampling.Head([b"the", b"of", b"of the"], s)
    for run in [(b"of", b"the"), (b"the", b"cat"), (b"a", b"b", b"c"), ("é".encode(), b"x")]:
        assert head.runs[run] == zlib.crc32(b" ".join(run)) % (1 << 20)
    assert len(head.states) == 2 and (b"of", b"the") in head.runs and (b"the", b"cat") not in head.runs


def test_counts_in_a_task_stay_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(resampling, "_HELD", 50)
    texts = [" ".join(["hot"] * 5 + [f"r{i}x{j}" for j in range(20)]) for i in range(50)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    (out,) = resampling._reported([batch], 1)
    assert out.column("feature")[0].as_py() == b"hot" and out.num_rows <= 71


# --- filter audit -------------------------------------------------------------------------------------------------------


def brute_audit(counts):
    rows, shares = [], Counter()
    for order in permutations("ABCDE"):
        gone = 0
        for step, name in enumerate(order, 1):
            bit = 1 << "ABCDE".index(name)
            here = [c for m, c in counts.items() if m & bit and not m & gone]
            fails = sum(c[0] for m, c in counts.items() if m & bit)
            removed = sum(c[0] for c in here)
            kept = sum(c[0] for m, c in counts.items() if not m & (gone | bit))
            shares[name] += removed
            rows.append(["".join(order), step, kept, removed, fails - removed, counts.get(bit, (0,))[0],
                         sum(c[1] for c in here), sum(c[2] for c in here), name])
            gone |= bit
    return sorted((*r[:-1], shares[r[-1]]) for r in rows)


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.tuples(*[st.integers(0, 5)] * 3)))
def test_diagram_steps(counts):
    assert sorted(audit.audit_part(counts)) == brute_audit(counts)


@pytest.mark.parametrize("n", range(1, 7))
def test_swaps_visit_every_order_once(n):
    order = list(range(n))
    seen = [tuple(order)]
    for level in audit.adjacent_swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert len(seen) == math.factorial(n) and set(seen) == set(permutations(range(n)))


def test_swap_keeps_what_a_diagram_says():
    counts = {m: (m * m % 7, m) for m in range(16)}
    diagram = audit.Diagram(counts, 4)
    for level in audit.adjacent_swaps(4):
        diagram.swap(level)
        for mask in range(16):
            node = diagram.root
            for of in diagram.order:
                node = diagram._kids[node][mask >> of & 1]
            assert diagram._weights[node] == counts[mask]


def test_audit(spark):
    words = " ".join(f"từ{i}" for i in range(250))
    docs = [
        (1, words, "a"), (2, words, "a"), (2, words, "b"), (3, words, None), (None, words, "a"), (4, None, "a"), (5, "", "a"),
        (6, "x " * 300, "b"), (7, "ABC " * 10 + words, "b"), (8, words + " 5 % |", "c"), (9, "A#", "c"), (9, "A#", "c"),
        (10, " ".join(["z"] * 300), ""), (11, "x\t\x0by\x0cz\r\n" * 200, "c"),
        *[(1000 + i, "hot copy", "h") for i in range(1500)],
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (6, 0, 1), (9, 1, 1), (None, 1, 1), (1400, 1, 1), (77, 1, 1)]
    first, counts = {}, {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for doc_id, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [
            len(w) < 200,
            100 * len(set(w)) < 50 * len(w),
            100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)),
            doc_id is not None and doc_id > first[t],
        ]
        mask = sum(1 << i for i, f in enumerate(fails) if f)
        part = counts.setdefault(source or "", {})
        n, g, x = part.get(mask, (0, 0, 0))
        part[mask] = (n + 1, g + (doc_id in good), x + (doc_id in toxic))
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, mask int, part string")
    got = audit.audit_filters(df.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    wanted = sorted((part, *row) for part, masks in counts.items() for row in brute_audit(masks))
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == wanted
    empty = audit.audit_filters(df.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.collect() == [] and empty.columns == names
