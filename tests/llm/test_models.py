"""Language ID, quality and personal data."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SMALL
from edge import LONG, ROWS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import grams, langid, pii, quality, queries

BIGGER = SMALL.replace("sf0.001", "sf0.01")


# -- language ID -----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op9_langid"](spark, BIGGER)
    truth = spark.read.parquet(f"{BIGGER}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_language_edges(spark):
    model = langid.train(documents(spark))
    assert model.languages == ["en", "fr"]
    out = langid.predict(documents(spark), model, carry=("doc_id", "text", "lang_pred"), pred_col="p", score_col="s")
    got = out.collect()
    assert len(got) == len(ROWS) and out.columns == ["doc_id", "text", "lang_pred", "p", "s"]
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["p"] != "und") == letters and (0 < r["s"] <= 1 if letters else r["s"] == 0)
    kept = langid.keep_identified(documents(spark), model)
    assert kept.columns == documents(spark).columns and kept.count() == sum(r["p"] != "und" for r in got)
    none = langid.train(empty(spark))
    assert none.languages == [] and {r["lang_pred"] for r in langid.predict(documents(spark), none).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_log_sums_match_counting_one_by_one():
    rng = np.random.default_rng(1)
    model = langid.LanguageModel(["a", "b"], np.array([-0.5, -1.0]), rng.normal(size=(1 << 12, 2)).astype(np.float32), (1, 2, 3), 12)
    texts = ["hello", "", "é à", "x" * 100_000]
    whole = langid._log_sums(model, texts, 1 << 20)
    for i, t in enumerate(texts):
        cells, _ = grams.char_cells([t], model.orders, model.bits)
        want = model.log_prob[cells].astype(float).sum(axis=(0, 1)) + model.log_prior
        assert np.allclose(whole[i], want) and np.allclose(langid._log_sums(model, texts, 997)[i], want)


# -- quality ---------------------------------------------------------------------------------


def test_held_out_quality(spark):
    got = queries.QUERIES["op1_quality"](spark, BIGGER)
    labels = spark.read.parquet(f"{BIGGER}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.97


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (5, None), (None, 1), (8, 1), (12, 0)], "doc_id bigint, quality int")
    model = quality.train(documents(spark), labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(documents(spark), model).collect()}
    bias = 1 / (1 + np.exp(-model.bias))
    assert got[4] == got[5] == got[6] and abs(got[4] - bias) < 1e-12
    assert all(0 <= s <= 1 for s in got.values())
    blank = quality.train(documents(spark), labels.limit(0))
    assert {r["score"] for r in quality.score(documents(spark), blank).collect()} == {0.5}
    assert quality.score(empty(spark), model).count() == 0


def test_score_is_a_sparse_dot_product():
    texts = [b"Some words, some WORDS!!", b"", b"caf\xc3\xa9 42"]
    cells, doc = quality.features(texts, 16)
    one = [quality.features([t], 16)[0] for t in texts]
    for i, c in enumerate(one):
        assert np.array_equal(cells[doc == i], c)
    assert len(one[0]) == 6 and cells[0, 0] == cells[3, 0] != cells[1, 0]


def plain_ftrl(examples, size, epochs, alpha, beta, l1, l2):
    """FTRL-proximal, one coordinate after another."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for cells, values, label in examples:
            ws = [weight(i) for i in cells]
            margin = max(-35.0, min(35.0, sum(w * v for w, v in zip(ws, values))))
            p = 1 / (1 + math.exp(-margin))
            for i, v, w in zip(cells, values, ws):
                g = (p - label) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w
                n[i] += g * g
    return [weight(i) for i in range(size)]


def plain_example(text, bits):
    """Cells with their scaled counts, and the bias last, from the cells of one text."""
    cells = quality.features([text.encode()], bits)[0]
    counts = Counter(int(c) for row in cells for c in row)
    scale = 1 / math.sqrt(max(1, len(cells)))
    return [*sorted(counts), 1 << bits], [*(counts[c] * scale for c in sorted(counts)), 1.0]


TEXTS = ["good words here, many good words", "Spam SPAM spam!!!", "", "a fine plain text about words", "BUY now now now", "words"] * 4


def test_ftrl_is_the_plain_loop():
    bits, settings_ = 8, (3, 0.3, 1.0, 0.02, 0.5)
    plain = [(*plain_example(t, bits), i % 2) for i, t in enumerate(TEXTS)]
    arrays = [(np.array(c), np.array(v), y) for c, v, y in plain]
    got = quality.ftrl(arrays, bits, *settings_)
    want = plain_ftrl(plain, (1 << bits) + 1, *settings_)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-14) and np.count_nonzero(got) > 20


def test_training_and_scores_are_the_plain_ones(spark):
    """One shard: the whole way from rows to scores by loops over words' cells."""
    bits = 9
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    docs, labels = documents(spark, rows), spark.createDataFrame([(i, i % 3 == 0) for i in range(len(TEXTS))], "doc_id long, quality boolean")
    model = quality.train(docs, labels, bits=bits, shards=1)
    turn = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64(F.lit(11), "doc_id")).collect()}
    examples = [(*plain_example(t or "", bits), int(i % 3 == 0)) for i, t, *_ in sorted(rows, key=lambda r: turn[r[0]])]
    w = np.array(plain_ftrl(examples, (1 << bits) + 1, 3, 0.3, 1.0, 0.02, 0.5), np.float32)
    assert np.allclose(model.weights, w[:-1]) and abs(model.bias - w[-1]) < 1e-7
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i, t, *_ in rows:
        cells, values = plain_example(t, bits)
        margin = sum(float(w[c]) * v for c, v in zip(cells, values))
        assert abs(got[i] - 1 / (1 + math.exp(-margin))) < 1e-6


# -- personal data ---------------------------------------------------------------------------

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                odd = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(odd) % 10:
                    continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


pieces = st.sampled_from(["a", "b.c", "@", ".", "-", "+", "1", "4539 1488 0343 6467", "255", "256", "10.0.0.1", " ", "(", ")", "é", "%", "00", "x@y.zz", "\n", "٣"])


@settings(max_examples=500, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 100_000, "+1 " * 60_000, "1 (" * 60_000):
        pii.nodes(text, pii.base_spans(text))


def test_field(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    field = pii.train(docs)
    said = "Call +1 (955) 555-8761 today. Later: 955 555-8761, or 1 955 555 8761. Order 20230405 of 7654321."
    clean = "In 2023 about 1234567 people came, 7654321 left."
    (base, spans), (none, added) = pii.all_spans(field, [said, clean])
    assert set(base) < set(spans) and none == added == []
    assert {said[a:b] for k, a, b in spans if k == 3} == {"+1 (955) 555-8761", "955 555-8761", "1 955 555 8761"}
    got = pii.find(documents(spark, [*ROWS, (90, said, "en", "a", 1)]), field).collect()
    assert len(got) == len(ROWS) + 1
    row = next(r for r in got if r["doc_id"] == 90)
    assert (row["n_phone"], row["n_card"]) == (1, 0) and row["spans"].count("phone:") == 3
    assert pii.find(empty(spark), pii.train(empty(spark))).count() == 0
    assert pii.all_spans(field, [LONG])[0] == ([], [])


def test_hidden_repeats_are_found_and_clean_documents_left(spark):
    """Held-out documents: bare repeats of their sure spans, far away, and documents with none."""
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    field = pii.train(docs.filter(~held))
    texts = [r["text"] for r in docs.filter(held & F.col("text").isNotNull()).select("text").collect()]
    hidden = found = false = clean = 0
    for text in texts:
        base = pii.base_spans(text)
        phones = [text[a:b].lstrip("+") for k, a, b in base if k == 3]
        phones += [p.replace(" ", ".").replace("-", " ") for p in phones]
        if phones:
            longer = text + " and so on" * 30 + "".join(f" then {p} again," for p in phones)
            (_, spans), = pii.all_spans(field, [longer])
            hidden += len(phones)
            found += sum(k == 3 and a > len(text) for k, a, b in spans)
        elif not base:
            (_, spans), = pii.all_spans(field, [text + " In 2023 about 1234567 people came; order 7654321."])
            clean, false = clean + 1, false + bool(spans)
    assert hidden >= 10 and found / hidden > 0.9, (found, hidden)
    assert clean > 300 and false == 0, (false, clean)


def test_fit_climbs_the_pseudo_likelihood():
    """The bond is learned: it grows where repeats agree and falls where they do not."""
    rng = np.random.default_rng(0)
    n = 2000
    label = (rng.random(n) < 0.5).astype(int) * 4
    cells, none = np.full((n, 6), 7), np.full(n, -1)
    other = np.where(rng.random(n) < 0.5, label, 4 - label)
    for same, test in ((label, lambda b: b > pii.BOND_PRIOR), (other, lambda b: b < 1)):
        repeats = np.eye(pii._LABELS, dtype=int)[same]
        field = pii.fit(label, cells, none, none, repeats, rounds=400)
        assert test(field.bond), field.bond


def test_swinging_documents_settle_by_mean_field():
    """A frustrated loop: no rounds of passing are left, and the posteriors are still probabilities."""
    chain = np.full((pii._LABELS, pii._LABELS), 0.0)
    np.fill_diagonal(chain, -9.0)
    field = pii.Field(np.zeros((pii._CELLS, pii._LABELS)), chain, 9.0)
    own = pii.nodes("x 955 555-8761 y 955 555-8761 z 955 555-8761 w", [])
    p = pii.posteriors(field, [own], rounds=1)
    assert np.allclose(p.sum(axis=1), 1) and p.shape == (3, pii._LABELS)


def brute_marginals(field, own):
    """Exact marginals over all labellings of a few nodes."""
    n = len(own)
    pairs = [(i - 1, i, field.chain) for i in range(1, n)]
    pairs += [(a, b, field.bond * np.eye(pii._LABELS)) for a, b in {*pii._skips([own]), *pii._anchors([own])}]
    out = np.zeros((n, pii._LABELS))
    for ys in itertools.product(range(pii._LABELS), repeat=n):
        if any(x.label and x.label != y for x, y in zip(own, ys)):
            continue
        w = sum(0.0 if x.label else field.unary[x.cells, y].sum() for x, y in zip(own, ys)) + sum(t[ys[a], ys[b]] for a, b, t in pairs)
        for i, y in enumerate(ys):
            out[i, y] += math.exp(w)
    return out / out.sum(axis=1, keepdims=True)


def test_posteriors_are_exact_on_trees():
    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii._CELLS, pii._LABELS)), rng.normal(size=(pii._LABELS, pii._LABELS)), 2.0)
    for text in ("a 955 555-8761 b 222 555-1234 c", "+1 (955) 555-8761 so 333 444-5555 or 777 888-9999", "call 955 555-8761"):
        own = pii.nodes(text, pii.base_spans(text))
        assert np.allclose(pii.posteriors(field, [own]), brute_marginals(field, own), atol=1e-3)


def test_sure_spans_reach_all_repeats_of_a_document():
    """However many repeats lie between, and however many documents are settled with them."""
    unary = np.zeros((pii._CELLS, pii._LABELS))
    said, sure = "955 555-8761", "+1 (955) 555-8761"
    node = pii.nodes(f"x {said} y", [])[0]
    unary[node.cells[0], 0] = 1.0  # one nat for: not personal
    field = pii.Field(unary, np.zeros((pii._LABELS, pii._LABELS)), 8.0)
    for n in (50, 500):
        first = f"{sure} then" + f" w {said} w" * n
        last = f" w {said} w" * n + f" then {sure}"
        plain = f" w {said} w" * n
        found = pii.all_spans(field, [first, plain, last])
        assert [len(spans) for _, spans in found] == [n + 1, 0, n + 1]
        own = [pii.nodes(t, pii.base_spans(t)) for t in (first, last)]
        alone = np.concatenate([pii.posteriors(field, [o]) for o in own])
        assert np.allclose(pii.posteriors(field, own), alone, atol=1e-3)
