"""Edge cases of every operator against brute force on small tables."""

import collections
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobweave.llm import chat, decontamination, fingerprints, lm, neardup, packing, pages, quality, suffixes, toxicity
from jobweave.llm.components import components

DOCS = "doc_id long, text string"
PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf at night"


def words(n, seed=0):
    draw = np.random.default_rng(seed)
    return " ".join("".join(draw.choice(list("abcdeé"), draw.integers(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = words(300, 1)
    near = base.split()
    near[100] = "other"
    return [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, "a b"),
        (7, "A  b"),
        (8, words(200, 2) + " " + PASSAGE + " " + words(100, 3)),
        (9, PASSAGE.upper() + " " + words(50, 4)),
        (10, "=" * 500),
        (11, "=" * 300 + PASSAGE + "-" * 60),
        (12, words(5000, 5) + PASSAGE),
        (13, "x" + PASSAGE + "y"),
        (14, "z" + PASSAGE + "w"),
        (14, "z" + PASSAGE + "w"),
        (15, "é" * 100),
        (16, "a" + "é" * 100),
        (None, PASSAGE),
        (-3, words(100, 6)),
    ]


# suffix-array dedup


def removed(rows, length=50):
    """Each byte covered by a stretch that also starts in a smaller document."""
    order = lambda i: -(1 << 63) if i is None else i
    least = {}
    raws = [(order(i), (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for (i, raw), (doc_id, _) in zip(raws, rows):
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < i:
                gone[p : p + length] = True
        gone = gone[:-1]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("largest", [suffixes.LARGEST, 1])
def test_repeats(frame, texts, largest):
    """The second case sends every anchor with different surroundings the way of hot ones."""
    got = suffixes.remove_repeats(frame(texts, DOCS), largest=largest).collect()
    assert sorted((tuple(r) for r in got), key=str) == removed(texts)


def test_repeats_random(frame):
    draw = np.random.default_rng(9)
    blocks = [words(12, s) for s in range(12)]
    rows = [(int(i), "".join(draw.choice(blocks) + draw.choice(["", "!", " "]) for _ in range(draw.integers(1, 9)))) for i in range(60)]
    got = suffixes.remove_repeats(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == removed(rows)


def test_maximal_repeats():
    """Every maximal repeat among the surroundings, with all its occurrences."""
    draw = np.random.default_rng(4)
    anchor = bytes(draw.integers(97, 123, suffixes.ANCHOR, dtype=np.uint8))
    arounds = [
        bytes(draw.integers(97, 99, 5, dtype=np.uint8)) * 5 + anchor + bytes(draw.integers(97, 99, 5, dtype=np.uint8)) * 5
        for _ in range(40)
    ]
    arounds = sorted(set(arounds))
    n = len(arounds)
    tree = suffixes.Intervals(np.zeros(n, np.int64), np.full(n, suffixes.REACH), arounds)
    got = {(s, k, frozenset(m.tolist())) for s, k, m in tree.maximal()}
    want = set()
    for start in range(suffixes.REACH + 1):
        for i in range(n):
            for end in range(start + suffixes.LENGTH, len(arounds[0]) + 1):
                same = frozenset(j for j in range(n) if arounds[j][start:end] == arounds[i][start:end])
                left = {arounds[j][start - 1 : start] if start else j for j in same}
                right = {arounds[j][end : end + 1] or j for j in same}
                if len(same) > 1 and len(left) > 1 and len(right) > 1:
                    want.add((start, end - start, same))
    assert got == want


def test_repeats_of_nothing(frame):
    assert suffixes.remove_repeats(frame([], DOCS)).collect() == []
    df = frame([(1, PASSAGE, "k"), (2, "a" + PASSAGE, None)], DOCS + ", text_b string")
    kept = suffixes.without_repeats(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, PASSAGE, "k", "x"), (2, "a", None, "x")]


def test_repeats_keep_whole_characters(frame):
    rows = [(1, "é" * 60), (2, "a" + "é" * 59 + "è")]
    left = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(frame(rows, DOCS)).collect()}
    assert left[1] == "é" * 60 and left[2] == "aè"


# decontamination


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, PASSAGE), (2, "a b"), (3, None), (4, "!?"), (5, "wolf"), (6, PASSAGE), (6, "quick BROWN fox"), (10, "Fox jumps: over")]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:1], []])
def test_decontamination(frame, texts, items):
    got = decontamination.decontaminate(frame(texts, DOCS), frame(items, "item_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == contaminated(texts, items)


def test_decontamination_in_rounds(frame, texts, monkeypatch):
    for name, value in (("ROUND_BYTES", 40), ("PIECE_WORDS", 2), ("CHUNK_BYTES", 100)):
        monkeypatch.setattr(decontamination, name, value)
    items = frame(ITEMS, "item_id long, text string")
    got = decontamination.decontaminate(frame(texts, DOCS), items).collect()
    assert sorted((tuple(r) for r in got), key=str) == contaminated(texts, ITEMS)
    clean = decontamination.without_contaminated(frame(texts, DOCS), items).select(*DOCS.split()[::2]).collect()
    assert Counter(r["doc_id"] for r in clean) == Counter(r[0] for r in contaminated(texts, ITEMS) if not r[5])


def test_pieces_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
    items = [(1, words(60, 4)), (2, "A b"), (3, None), (4, "?"), (5, " ".join("abcdefghij")), (6, words(23, 5))]
    pieces = list(decontamination.item_pieces(items))
    assert decontamination.items_windows(pieces) == decontamination.items_windows(items)
    assert max(len(t.split()) for _, t in pieces) <= 7 + 9


def test_long_text_is_searched_whole():
    sets = decontamination.search_sets([(1, PASSAGE)])
    text = " ".join([words(3000, 7), PASSAGE, words(3000, 8), PASSAGE])
    _, flags, _, found = decontamination.hits([text], sets)
    assert flags.sum() == 2 * len(PASSAGE.split()) and found == [{1}]


# toxicity and quality


def labelled(n=900):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = words(40, i) + (" awful horrid nasty" if bad else " kind fine") + " " + words(20, i + 5000)
        rows.append((i, text))
        labels.append((i, int(not bad), int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity(frame):
    rows, labels = labelled()
    rows += [(10_000, None), (10_001, ""), (None, "awful"), (0, rows[0][1])]
    labels += [(None, 1, 1), (3, 1, 1), (7, None, None), (8, 3, 3)]
    got = toxicity.toxicity(frame(rows, DOCS), frame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.95
    model = toxicity.fit(frame(rows, DOCS), frame(labels, LABELS))
    assert len(model[0]) < 1000
    kept = toxicity.without_toxic(frame(rows, DOCS), model)
    assert kept.columns == ["doc_id", "text", "block"] and kept.count() == sum(r["predicted"] == 0 for r in got)


def test_no_labels(frame):
    got = toxicity.toxicity(frame([(1, "a"), (2, None)], DOCS), frame([], LABELS)).collect()
    assert [r["score"] for r in got] == [0.5, 0.5]
    got = quality.quality(frame([(1, "a"), (2, None)], DOCS), frame([], LABELS)).collect()
    assert len(got) == 2 and toxicity.toxicity(frame([], DOCS), frame([], LABELS)).count() == 0


def test_quality(frame):
    rows = [(i, words(60, i) if i % 3 else re.sub(" ", "%%% ", words(60, i))) for i in range(400)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(400)]
    rows += [(1000, None), (1001, "")]
    got = quality.quality(frame(rows, DOCS), frame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 > 0) for r in held]) > 0.95


def test_chunks_cover_the_text():
    for n in (0, 1, quality.CHUNK, quality.CHUNK + 1, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        rows, first = quality.chunked([text])
        assert first.tolist() == [0, len(rows)]
        joined = b"".join(bytes(r[: quality.STRIDE]) for r in rows[:-1]) + bytes(rows[-1])
        assert joined.rstrip(b"\0") == text.encode()


def test_gradients_match_differences():
    draw = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in quality.new_model().items()}
    rows, first = quality.chunked([words(300, 1), "short"])
    labels = np.array([1.0, 0.0])

    def loss():
        p = toxicity.sigmoid(quality.text_features(quality.pooled(rows, model)[0].astype(np.float64), first) @ model["out"] + model["out_bias"])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    found = quality.gradients(rows, first, labels, model)
    for name in ("filters", "out", "filter_bias"):
        at = tuple(draw.integers(0, s) for s in model[name].shape)
        model[name][at] += 1e-3
        high = loss()
        model[name][at] -= 2e-3
        low = loss()
        model[name][at] += 1e-3
        assert abs((high - low) / 2e-3 - found[name][at]) < 2e-3


# packing


def test_packing(frame, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = [*texts, (20, words(20_000, 8)), (21, "a<|endoftext|>b c")]
    got = packing.pack(frame(rows, DOCS)).collect()
    wanted = Counter()
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            part = np.array(ids[start : start + 2048], dtype="<u4")
            wanted[(doc, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in got) == wanted
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= math.ceil(total / 2048) + 1


def test_first_fit_decreasing():
    sizes = np.sort(np.random.default_rng(1).integers(1, 101, 500))[::-1]
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, want = [], []
    for s in sizes:
        k = next((i for i, free in enumerate(room) if free >= s), len(room))
        if k == len(room):
            room.append(100)
        want.append((k, 100 - room[k]))
        room[k] -= s
    assert list(zip(bins.tolist(), offsets.tolist())) == [(k, int(o)) for k, o in want]


def test_pieces_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    draw = np.random.default_rng(2)
    letters = list("ab é'!,.€1 \n\t«日\xa0$%|<>×ß \x1c\x85")
    texts = ["".join(draw.choice(letters, draw.integers(0, 40))) for _ in range(3000)]
    for text, raw in zip(texts, packing.Encoder(packing.default_tokenizer()).encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_nothing(frame):
    assert packing.pack(frame([], DOCS)).collect() == []


# language model


def test_lm_base_and_counts(frame, texts):
    rows = [*texts, *[(100 + i, words(80, 50 + i % 7)) for i in range(60)]]
    got = lm.lm_scores(frame(rows, DOCS)).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        want.append((str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)))
    have = [(str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got]
    assert sorted(have) == sorted(want)
    assert all(r["score"] <= 0 for r in got)
    known = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 100]
    assert known and all(r["score"] > r["base_score"] for r in known)


def test_lm_probabilities_sum_to_one():
    """Over all known words and one unknown, for any context and weights."""
    word = np.array([5.0, 3.0, 2.0, 0.0])
    pair = np.array([2.0, 1.0, 1.0, 0.0])
    two, one, zero = lm.estimates(pair, np.full(4, 4.0), word, 10, 3)
    assert abs(two.sum() - 1) < 1e-12 and abs(one.sum() - 1) < 1e-12 and abs(4 * zero - 1) < 1e-12


def test_em_finds_the_better_estimate():
    cells = [((3 * lm.BINS + 100) * lm.BINS + 50, 1000, 5e6, 1e3), ((3 * lm.BINS + 0) * lm.BINS + 50, 10, 0.0, 10.0)]
    weights = lm.learned_weights(cells)
    assert weights[3][0] > 0.9 and np.allclose(weights.sum(axis=1), 1)
    assert lm.learned_weights([]).sum() == lm.FREQUENCIES


def test_lm_of_nothing(frame):
    assert lm.lm_scores(frame([], DOCS)).collect() == []
    alone = lm.lm_scores(frame([(1, None), (1, "")], DOCS)).collect()
    assert [r["n_tokens"] for r in alone] == [1, 1]


# chat


def test_chat_round_trip(frame):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok <\\|x <\\\\| <| <"
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (2, 0, "assistant", None),
        (2, 1, None, "x"), (2, 1, None, "x"), (None, 0, "us\ner%", ""), (3, 0, "user", "long " * 20_000),
    ]
    df = frame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.format_chats(df)).collect()}
    assert len(got) == 4
    for conv in got:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learned)
    assert got[1]["valid"] and got[3]["valid"] and not got[2]["valid"] and not got[None]["valid"]
    segments = chat.format_chats(df).collect()
    assert sum(len(s["segment"]) for s in segments if s["conv_id"] == 1) == got[1]["formatted_chars"]
    marks = [s["segment"] for s in segments if s["part"] == "text"]
    assert not any(chat.START in m or chat.END in m for m in marks)
    assert all(chat.unescape(chat.escape(t)) == t for t in (nasty, "<", "<|", "<\\|", "|"))


# fingerprints


def chunks_by_hand(raw):
    """The same rule, byte by byte."""
    cuts, at = [], 0
    while at < len(raw):
        end = len(raw)
        for p in range(at + fingerprints.LEAST, min(at + fingerprints.MOST, len(raw))):
            h = 0
            for b in raw[max(0, p - 32) : p]:
                h = (h * 2 + int(fingerprints.GEAR[b])) & 0xFFFFFFFF
            bits = fingerprints.HARD_BITS if p < at + fingerprints.NORMAL else fingerprints.EASY_BITS
            if h >> (32 - bits) == 0:
                end = p
                break
        else:
            end = min(at + fingerprints.MOST, len(raw))
        cuts.append(end)
        at = end
    return cuts


def test_chunk_boundaries():
    raws = [words(n, n).encode() for n in (1, 20, 400)] + [b"", b"=" * 700, words(900, 3).encode()[:-1]]
    assert fingerprints.boundaries(raws) == [chunks_by_hand(r) for r in raws]


@pytest.mark.parametrize("stretch", [1 << 30, 500])
def test_fingerprints(frame, texts, stretch):
    got = fingerprints.fingerprints(frame(texts, DOCS), stretch_bytes=stretch).collect()
    rows = sorted(((-(1 << 63) if i is None else i, t or "", i) for i, t in texts))
    want = []
    for k, (_, text, doc) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = fingerprints.edited_text(text, following)
        assert len(text) < 2 or edited == text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        a, b, c = fingerprints.digest_sets([s.encode() for s in (text, edited, following)])
        want.append(
            (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.fingerprint(a),
             fingerprints.fingerprint(b), fingerprints.likeness(a, b), fingerprints.likeness(a, c))
        )
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 1000])
def test_stretches_by_binary_search(spark, n):
    cuts = [3 * i for i in range(n)]
    rows = spark.range(-2, 3 * n + 3).select("id", fingerprints.stretch_number(F.col("id"), cuts).alias("n"))
    assert all(r["n"] == sum(c < r["id"] for c in cuts) for r in rows.collect())


def test_fingerprints_survive_shifts():
    base = words(2000, 1)
    a, b, c = fingerprints.digest_sets([base.encode(), ("new start " + base).encode(), words(2000, 2).encode()])
    assert fingerprints.likeness(a, b) > 0.95 and fingerprints.likeness(a, c) == 0 and fingerprints.likeness(a, a) == 1


def test_fingerprints_of_one_row(frame):
    assert fingerprints.fingerprints(frame([], DOCS)).collect() == []
    [row] = fingerprints.fingerprints(frame([(5, "abcdef")], DOCS)).collect()
    assert row["near_next"] == 1 and row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


# pages


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_page_text(frame):
    rows = [
        (1, "https://a.example/x", page("<nav><ul><li>menu</ul></nav><article><h1>T &amp; U</h1><p>one\n two<b>3</b><br>four<p>five"
            "<div class='share-bar'>share</div><aside>no</aside><section id=comments><p>bad</p></section></article><footer>f</footer>")),
        (2, "https://a.example/y", page("<header>h</header><main><p>m&#233;n &lt;b&gt;</p><form>f</form></main>")),
        (3, None, page("<div class=\"cookie-notice\">c</div><p title='a>b'>body</p><!-- <p>no</p> --><style>p{}</style>")),
        (4, "bad", None), (5, "https://b.example/", ""), (5, "https://b.example/", "just text <i>here"),
        (6, "https://b.example/", "<article><p>cut &am</art"),
    ]
    got = pages.extract_pages(frame(rows, "page_id long, url string, html string")).collect()
    texts = sorted((r["page_id"], r["text"], r["n_chars"]) for r in got)
    want = [
        (1, "T & U\none two3 four\nfive"), (2, "mén <b>"), (3, "body"), (4, ""), (5, ""), (5, "just text here"), (6, "cut &am"),
    ]
    assert texts == [(i, t, len(t)) for i, t in want]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<div class='content has-sidebar'><article><p>real text</article></div>", "real text"),
        ("<div id='no-sidebar-layout'><article><p>real text</article></div>", "real text"),
        ("<div class=long-form>real text</div><div class=share>x</div>", "real text"),
        ("<form><main><p>real text</main><p>x</form>", "real text"),
        ("<article><p>real text <math>x</math> <label>y</label><div class=notice><p>mind</div></article>", "real text x y\nmind"),
        ("<main><p>long text of the page itself<article><p>card</article><article><p>more</article></main>",
         "long text of the page itself\ncard\nmore"),
    ],
)
def test_names_alone_cut_no_text(body, want):
    assert alone(body) == want


def host_tree(parsed):
    """Cut branches of one host's pages, all counted here; a text that stands on several pages of the same text counts once."""
    counts = collections.defaultdict(collections.Counter)
    sizes = {}
    for same in {pages.main_text(blocks): (blocks, children) for blocks, children in parsed}.values():
        for node in pages.page_nodes(*same):
            counts[node["path"], node["content"]][node["feature"]] += 1
            sizes[node["path"], node["content"], node["feature"]] = node["chars"], node["links"]
    rows = []
    for (path, content), features in counts.items():
        m = sum(features.values())
        entropy = -sum(n / m * math.log(n / m) for n in features.values()) / math.log(m) if m > 1 else 1.0
        chars, links = (sum(n * sizes[path, content, f][k] for f, n in features.items()) for k in (0, 1))
        rows.append((path, content, m, entropy, chars, links))
    return set(pages.low_branches(pd.DataFrame(rows, columns=["path", "content", "pages", "importance", "chars", "links"])))


def alone(body):
    parsed = pages.parse(page(body))
    return pages.main_text(parsed[0], host_tree([parsed]))


POST = "<article><h1>Title</h1><p>The story itself, told at some length.</p>{inside}</article>"


@pytest.mark.parametrize("n", [1, 4, 50])
@pytest.mark.parametrize(
    "body",
    [
        POST + "<div class='cookie-banner'><p>We use cookies</p></div>",
        "<div class='post'><h1>Title</h1><p>The story itself, told at some length.</p></div><div class='cookie-banner'><p>We use cookies</p></div>",
        "<div class='post'><h1>Title</h1><p>The story itself, told at some length.</p></div><div class='comments-section'><p>Great post {i}</p></div>",
        POST.replace("{inside}", "<div class='comment-list'><p>Great post {i}!</p></div>"),
        POST.replace("{inside}", "<div class='ad-slot'><p>Buy now {i}</p></div>"),
        "<main><h1>Title</h1><p>The story itself, told at some length.</p><div class='newsletter-signup'><p>Sign up today</p></div></main>",
        "<div id='sidebar-left'><ul><li>Link one</li></ul></div><div class='x'><h1>Title</h1><p>The story itself, told at some length.</p></div>",
        "<div class='x'><h1>Title</h1><p>The story itself, told at some length.</p></div><div class='comments'><p>" + "so long {i} " * 40 + "</p></div>",
        POST + "<div class='commentList'><article><p>" + "an answer {i} " * 40 + "</p></article></div>",
        POST + "<div class='z'><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></div>",
    ],
)
def test_furniture_goes_on_hosts_of_every_size(body, n):
    bodies = [body.replace("{inside}", "").replace("{i}", f"number{i}").replace("Title", f"Title {i}").replace("story", f"story{i}") for i in range(n)]
    parsed = [pages.parse(page(b)) for b in bodies]
    cut = host_tree(parsed)
    assert [pages.main_text(p[0], cut) for p in parsed] == [f"Title {i}\nThe story{i} itself, told at some length." for i in range(n)]


def test_tree_counts_like_one_host_in_plain_python(frame):
    """Importance, cuts and texts of a whole table against counting each host by itself."""
    source = duckdb.sql("SELECT page_id, url, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    source += [(1000 + i, f"https://big.example/{i % 9}", source[i % 40][2]) for i in range(60)]
    source += [(2000 + i, None, f"<div class=a><p>{words(9, i % 4)}</p></div><div class=b><p>same here</p></div>") for i in range(12)]
    hosts = collections.defaultdict(list)
    for page_id, url, html in source:
        found = re.search(r"://([^/?#]*)", url or "")
        hosts[found[1].lower() if found else ""].append((page_id, pages.parse(html)))
    want, changed = {}, 0
    for parsed in hosts.values():
        cut = host_tree([p for _, p in parsed])
        for page_id, (blocks, _) in parsed:
            want[page_id] = pages.main_text(blocks, cut)
            changed += any(not cut.isdisjoint(pages._above(b.path)) for b in blocks)
    got = pages.extract_pages(frame(source, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert changed > 250  # the tree takes something from the pages, such as their adverts


def test_shared_branches_are_cut(frame):
    rows = [
        (i, f"https://h.example/{i}", page(f"<div class=top><p>Welcome to our site</p></div><div class=body><p>{words(30, i)}</p></div>"))
        for i in range(20)
    ]
    rows += [(50 + i, f"https://k.example/{i}", page("<article><p>one same copy</p></article>")) for i in range(20)]
    got = {r["page_id"]: r["text"] for r in pages.extract_pages(frame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == words(30, i) for i in range(20))
    assert all(got[50 + i] == "one same copy" for i in range(20))


# near duplicates


def near_classes(rows, percent=75):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return sorted(((i, len(s), None if i is None else root(i), i is not None and root(i) == i) for i, s in sets), key=str)


def test_near_duplicates(frame, texts):
    draw = np.random.default_rng(3)
    rows = list(texts)
    for g in range(6):  # groups of copies with some words changed, around the threshold
        base = words(120, 100 + g).split()
        for k in range(8):
            changed = list(base)
            for p in draw.integers(0, 120, k):
                changed[p] = f"w{p}{k}"
            rows.append((200 + 10 * g + k, " ".join(changed)))
    got = neardup.near_duplicates(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_classes(rows)


def test_large_nodes_are_branched_on(frame, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    common = words(60, 77)
    rows = [(i, common + " " + words(40, 300 + i // 2)) for i in range(40)]
    got = neardup.near_duplicates(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_classes(rows)


def test_paths_keep_pairs_at_the_threshold(spark):
    """Classes that agree in a token with probability 0.75 still share a node after five steps down."""
    draw = np.random.default_rng(11)
    n = 2000
    one, two = (draw.integers(0, 1 << 32, (n, neardup.COORDINATES), dtype=np.uint32) for _ in range(2))
    two = np.where(draw.random(one.shape) < 0.75, one, two)
    rows = [(i, bytearray(t.astype("<u4").tobytes())) for i, t in enumerate(np.concatenate([one, two]))]
    classes = spark.createDataFrame(rows, "vertex long, tokens binary")
    places = neardup.root_places(classes)
    for _ in range(5):
        places = neardup.child_places(places.join(classes, "vertex")).distinct()
    met = places.selectExpr("node", f"vertex % {n} AS pair", "vertex").groupBy("node", "pair").count().where("count = 2")
    assert met.select("pair").distinct().count() == n


def test_classes_of_large_nodes_meet_on_rare_shingles(frame, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 8)
    common = words(300, 78)
    rows = [(i, f"{common} {words(15, 5000 + i // 2)} {words(49, 7000 + i)}") for i in range(40)]
    want = near_classes(rows)
    assert sum(not r[3] for r in want) == 20
    got = neardup.near_duplicates(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_an_id_has_the_links_of_all_its_texts(frame):
    one, two, three = words(60, 901).split(), words(60, 902).split(), words(60, 903).split()
    near = lambda w: " ".join([*w[:30], "changed", *w[31:]])
    rows = [
        (7, " ".join(one)), (7, " ".join(two)), (7, None), (9, near(one)), (8, near(two)), (8, " ".join(three)), (8, " ".join(three)),
        (11, near(three)), (12, "else"), (None, near(two)), (13, ""), (13, "a b c"), (5, "A b\tc"),
    ]
    got = neardup.near_duplicates(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_classes(rows)
    for _ in range(2):  # whichever text has the smaller tokens
        one, two = words(80, 910 + _).split(), words(80, 920 + _).split()
        rows = [(1, " ".join(two)), (1, " ".join(one)), (2, near(one))]
        assert {r["component_id"] for r in neardup.near_duplicates(frame(rows, DOCS)).collect()} == {1}


def test_clusters_of_many_bytes_meet_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 2000)
    draw = np.random.default_rng(5)
    base = words(150, 930).split()
    rows = []
    for i in range(60):  # a chain: each text changes the one before
        base[int(draw.integers(0, 150))] = f"c{i}"
        rows.append((i, " ".join(base)))
    got = neardup.near_duplicates(frame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == near_classes(rows)


def test_components_of_long_paths(spark):
    n = 3000
    order = np.random.default_rng(1).permutation(n).tolist()
    links = [(order[i], order[i + 1]) for i in range(n - 1) if i % 1000 != 999] + [(5, 5)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for k in range(0, n, 1000):
        part = order[k : k + 1000]
        assert {got[v] for v in part} == {min(part)}


def test_near_duplicates_of_nothing(frame):
    assert neardup.near_duplicates(frame([], DOCS)).collect() == []
    got = neardup.near_duplicates(frame([(3, None), (4, ""), (5, " ")], DOCS)).collect()
    assert sorted(tuple(r) for r in got) == [(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]
    kept = neardup.without_near_duplicates(frame([(1, "a"), (1, "a"), (2, "A"), (None, "a")], DOCS))
    assert kept.columns == ["doc_id", "text", "block"] and sorted(kept.collect(), key=str) == [(1, "a", "x"), (None, "a", "x")]
