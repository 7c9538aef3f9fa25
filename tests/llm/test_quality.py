import math
import random

import brute
import numpy as np
import pytest

from hourgrid.llm import quality

SCHEMA = "doc_id bigint, text string, lang string, source string"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def corpus(seed, rows=400):
    rng, out = random.Random(seed), []
    for i in range(rows):
        text = prose(rng, rng.randrange(40, 200))
        if i % 20 == 7:
            text = text.replace(" ", "&&& ")
        if i % 50 == 9:
            text = "\n".join([text[:300]] * 8)
        if i % 33 == 5:
            text = text + "\n" + "same line here\n" * 2
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None])))
    return out


def test_statistics(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\n\nx\n x\nx", "é# $\n日本 |", "\x0b\x0c a\x1cb"]
    texts += [prose(rng, 30) + "\n" + prose(rng, 5) for _ in range(5)] + ["a b " * 3000, "\n".join(["l l l"] * 50)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in quality.statistics(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, text in enumerate(texts):
        assert {k: got[i][k] for k in STATISTICS} == brute.text_statistics(text), repr(text)[:50]


def vector(s, text):
    """The parts, their sampling variances, and the relative variance of word lengths."""
    lines = sum(bool(brute.words(x)) for x in text.split("\n"))
    angle = lambda a, b: math.asin(math.sqrt(min(a / b, 1)))
    parts = (
        math.log(s["word_chars"] / s["n_words"]),
        angle(s["n_symbols"], s["word_chars"]),
        angle(s["n_repeat_words"], s["n_words"]),
        angle(s["n_dup_lines"], lines),
    )
    noise = (1 / s["n_words"], 1 / s["word_chars"], 3 / s["n_words"], 0.25 / lines)
    lengths = np.array([len(w) for w in brute.words(text)])
    spread = lengths.var() / lengths.mean() ** 2
    unit = quality.UNIT
    return [math.floor(x * unit + 0.5) for x in parts] + [math.ceil(x * unit**2) for x in noise] + [round(spread * unit**2)]


def mcd(rows):
    """Mean and covariance of a group: concentration steps over all rows, then all rows that they accept."""
    x, noise, spread = rows[:, :4], rows[:, 4:8], rows[:, 8]

    def moments(held, factor, two_parts=False):
        own, k = x[held], spread[held].mean() / quality.UNIT**2
        typical = np.maximum(noise[held].mean(0) * [k, 1, 1, 1], 1)
        cov = factor * np.cov(own.T, bias=True)
        least = np.array([1, *typical[1:]])
        if two_parts:
            prior = quality.PRIOR_ROWS
            least[1:] = (((own**2).sum(0) + prior * typical) / ((own > 0).sum(0) + prior))[1:]
        np.fill_diagonal(cov, np.maximum(cov.diagonal(), least))
        return own.mean(0), cov, k

    def far(mean, cov, d):
        return np.einsum("ij,jk,ik->i", d - mean, np.linalg.inv(cov), d - mean)

    best, factor = None, quality.consistency(quality.SUPPORT, 4)
    median = np.sort(x, axis=0)[(len(x) + 1) // 2 - 1]
    mean, cov, k = moments(slice(None), 1.0)
    start = np.maximum(noise.mean(0) * [k, 1, 1, 1], 1)
    for mean, cov in ((mean, cov), (median, np.diag(start))):
        for _ in range(quality.STEPS):
            bins = np.floor(np.log2(1 + far(mean, cov, x)) * quality.DISTANCE_BINS)
            limit = np.sort(bins)[math.ceil(len(x) * quality.SUPPORT) - 1]
            mean, cov, k = moments(bins <= limit, factor)
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0] - 1e-9:
            best = det, mean, cov, k
    held = np.array([judged(r, *best[1:]) for r in rows]) <= quality.cutoff()
    return moments(held, quality.consistency(1 - quality.CUTOFF_TAIL, 4), True)


def judged(row, mean, cov, k):
    """Distance of a row whose own noise counts where it is larger than the scatter."""
    shrink = np.minimum(1, np.sqrt(cov.diagonal() / np.maximum(row[4:8] * [k, 1, 1, 1], 1)))
    d = (row[:4] - mean) * shrink
    return float(d @ np.linalg.inv(cov) @ d)


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_are_those_of_the_estimate(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    stats = {i: brute.text_statistics(t) for i, t, *_ in rows}
    failed = {i: s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"] for i, s in stats.items()}
    vectors = {i: vector(stats[i], t) for i, t, *_ in rows if not failed[i]}
    place = {i: (lang, source) for i, _, lang, source in rows}
    limit = quality.chi_square_quantile(quality.CUTOFF_TAIL, 4)
    rejected = 0
    for i in got:
        assert got[i].base_failed == failed[i]
        if failed[i]:
            assert not got[i].kept
            continue
        own = [j for j in vectors if place[j] == place[i]]
        if len(own) < quality.GROUP_ROWS:
            own = [j for j in vectors if place[j][0] == place[i][0]]
        if len(own) < quality.GROUP_ROWS:
            own = list(vectors)
        estimate = mcd(np.array([vectors[j] for j in own], float))
        want = judged(np.array(vectors[i], float), *estimate)
        assert got[i].distance == pytest.approx(want, rel=1e-6, abs=1e-6)
        assert got[i].kept == (want <= limit)
        rejected += not got[i].kept
        if i % 20 == 7:
            assert not got[i].kept
    assert rejected >= 10


def test_edge_cases(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "x " * 60, "en", "a"), (3, "long " * 60_000, "en", "a")]
    rows += [(4, " ".join(f"w{i}" for i in range(60)), "en", None)] * 2
    got = quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r.doc_id, r.n_words, r.base_failed, r.kept)) for r in got) == sorted(
        map(str, [(1, 0, True, False), (2, 0, True, False), (None, 60, True, False), (3, 60_000, True, False)] + [(4, 60, False, True)] * 2)
    )
    assert quality.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    bare = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id bigint, text string")
    assert quality.judge(bare).first().kept


def test_kept_rows_come_as_they_are(spark):
    names = "group string, start string, det string, n_words string, t string, w string, _lang string"
    rows = [(*r, *"abcdefg") for r in corpus(5, 150)]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, {names}")
    kept = quality.keep_good(docs)
    want = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[0] in want) and 100 < len(want) < 150


def test_chi_square():
    assert quality.chi_square_quantile(0.001, 4) == pytest.approx(18.4668, abs=1e-3)
    assert quality.chi_square_tail(5.385, 4) == pytest.approx(0.25, abs=1e-3)


def test_no_python_in_the_plan(spark):
    plan = quality.judge(spark.createDataFrame(corpus(1, 30), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_junk_goes_and_clean_text_stays(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{folder}/documents.parquet")).where("not base_failed")
    joined = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    clean, junk = ([r.kept for r in joined if r.quality == q] for q in (1, 0))
    assert sum(clean) >= 0.99 * len(clean) and not any(junk) and junk


@pytest.mark.parametrize("part", ["lines", "word length", "words"])
def test_groups_own_scatter_decides(spark, part):
    rng = random.Random(8)
    lines = lambda: [prose(rng, 12) for _ in range(10)]
    rows = [(i, "\n".join(lines()), "en", "a") for i in range(200)]
    odd = {
        # Nine further copies of a short line: half of 18 lines, few of the words.
        "lines": "\n".join([*(prose(rng, 30) for _ in range(8)), *["so be it"] * 10]),
        # Words a quarter longer than elsewhere.
        "word length": "\n".join(" ".join(w + "jj"[: i % 3] for i, w in enumerate(x.split())) for x in lines()),
        # Almost half of the words are repeats, on one line each.
        "words": " ".join([prose(rng, 60), *["one two three"] * 18]),
    }[part]
    rows.append((200, odd, "en", "a"))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[200].base_failed and not got[200].kept
    assert sum(got[i].kept for i in range(200)) >= 195
