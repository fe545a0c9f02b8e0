"""JSON arrays read by ranges, and bulk files of an index."""

import io
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from jobweave.sources import arrays, readers

TEXTS = st.text(alphabet='ab"\\{}[],: \n\té\U0001f600', max_size=12)
RECORDS = st.lists(st.fixed_dictionaries({"s": TEXTS, "l": st.lists(TEXTS, max_size=3), "o": st.dictionaries(TEXTS, TEXTS, max_size=2)}))


def read_by_ranges(data: bytes, size: int):
    found, inside, depth = [], False, 0
    for start in range(0, len(data), size):
        end = min(start + size, len(data))
        file = io.BytesIO(data)
        found += list(arrays.records(file, start, end, inside, depth))
        quotes, outside, within = arrays.summary(data[start:end][arrays.escapes_before(file, start) :])
        depth += within if inside else outside
        inside ^= bool(quotes)
    return found


@settings(max_examples=200, deadline=None)
@given(RECORDS, st.integers(1, 80), st.booleans(), st.sampled_from([None, 0, 2]), st.sampled_from([b"", b"\xef\xbb\xbf", b" \n"]))
def test_ranges_hold_every_record_once(rows, size, ascii_only, indent, lead):
    data = lead + json.dumps(rows, ensure_ascii=ascii_only, indent=indent).encode()
    found = read_by_ranges(data, size)
    assert [json.loads(text) for _, text in found] == rows
    assert [place for place, _ in found] == sorted({place for place, _ in found})


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("data", [b'[{"a": 1}, {"a": 2', b'[{"a": 1} {"a": 2}]', b'[{"a": 1}, ]', b'[{"a": 1}, oops]', b"[", b'[{"a": "x]'])
def test_broken_arrays_are_told(data, size):
    assert None in [text for _, text in read_by_ranges(data, size)]


def test_no_array(spark):
    assert read_by_ranges(b"", 4) == [] and read_by_ranges(b" \n ", 4) == []
    assert read_by_ranges(b' {"a": [1, 2], "b": 3} ', 4) == [(0, '{"a": [1, 2], "b": 3}')]


def test_load_array_reads_like_one_task(spark, tmp_path):
    draw = random.Random(4)
    texts = ['say "x"', "a\\b", "[{,}]", "tiếng Việt", "", "line\nbreak"]
    files = {f"f{k}.json": [{"id": 1000 * k + i, "s": draw.choice(texts) * draw.randint(0, 4)} for i in range(n)] for k, n in enumerate([400, 0, 1, 90])}
    for name, rows in files.items():
        (tmp_path / name).write_text(json.dumps(rows, ensure_ascii=False, indent=draw.choice([None, 1])), encoding="utf-8")
    (tmp_path / "f8.json").write_text('{"id": 7, "s": "alone"}')
    (tmp_path / "f9.json").write_text('[{"id": 99999, "s": "lost"}, {"id": ')
    schema = T.StructType.fromDDL("id long, s string")
    found = arrays.load_array(spark, f"{tmp_path}/f*.json", schema, placed=True, range_bytes=256)
    assert found.select("_file", "_block").distinct().count() > 20
    rows = [(r["id"], r["s"]) for r in found.orderBy("_file", "_block", "_position").collect()]
    assert rows == [(r["id"], r["s"]) for name in sorted(files) for r in files[name]] + [(7, "alone")]
    one = readers.load_json(spark, f"{tmp_path}/f*.json", schema)
    assert sorted(map(tuple, one.where("id <> 99999").collect())) == sorted(rows)
