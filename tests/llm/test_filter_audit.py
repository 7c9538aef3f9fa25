import itertools
import random

from brute import words
from hourgrid.llm import filter_audit

DOCS = "doc_id bigint, text string, source string, mask string, part int, n string, copy int"
LABELS = "doc_id bigint, quality int, toxic int, part string"
EXTRA = ("x", 1, "y", 2)


def brute(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    failed = []
    for i, text, source in docs:
        text = text or ""
        w = words(text)
        fails = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": any(i is not None and j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        failed.append((source or "", i, {f for f, x in fails.items() if x}))
    out = {}
    for part in {p for p, _, _ in failed}:
        own = [(i, f) for p, i, f in failed if p == part]
        gone = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [i for i, f in own if letter in f and not f & before]
                out[part, order, step] = [
                    sum(not f & (before | {letter}) for _, f in own),
                    len(removed),
                    sum(letter in f and bool(f & before) for _, f in own),
                    sum(f == {letter} for _, f in own),
                    sum(i in good for i in removed),
                    sum(i in toxic for i in removed),
                    letter,
                ]
                gone[letter] = gone.get(letter, 0) + len(removed)
        for (p, _, _), row in out.items():
            if p == part:
                row[-1] = gone[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, labels):
    table = spark.createDataFrame([(*d, *EXTRA) for d in docs], DOCS)
    marks = spark.createDataFrame([(*x, "z") for x in labels], LABELS)
    rows = filter_audit.audit(filter_audit.cells(table, marks)).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(rows) == len(got) and rows == [] or set(rows[0].asDict()) == {
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    }
    return got


def test_equals_brute_force(spark):
    draw = random.Random(3)
    prose = lambda n, kinds: " ".join(draw.choice("abcdefgh") + str(draw.randrange(kinds)) for _ in range(n))
    texts = [prose(draw.randrange(20, 90), draw.choice((2, 400))) for _ in range(40)]
    texts += [t.upper() for t in texts[:6]] + [t + " #" for t in texts[6:12]]
    docs = [(i, draw.choice(texts), draw.choice(("a", "b", None, ""))) for i in range(120)]
    labels = [(i, draw.randrange(2), draw.randrange(2)) for i in range(0, 130, 2)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_nulls_copies_and_repeated_rows(spark):
    docs = [(5, None, None), (5, None, None), (3, "", "s"), (9, "", "s"), (None, "", "s"), (None, "x", None), (7, "x", "s")]
    docs += [(2, "one word É \x1f Ω", "s"), (2, "A", "s"), (4, "A", None), (8, "w " * 20_000, "t")]
    labels = [(5, 1, None), (5, 0, 1), (None, 1, 1), (9, None, 1), (8, 1, 0)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_limits_are_met_exactly(spark):
    fifty = " ".join(f"w{i}" for i in range(50))
    some = " ".join(f"w{i % 65}" for i in range(100))
    docs = [(1, fifty, "a"), (2, fifty[:-4], "a"), (3, some, "a"), (4, some + " w1", "a"), (5, "A" + "b" * 19, "a"), (6, "A" + "b" * 18, "a")]
    assert audited(spark, docs, []) == brute(docs, [])


def test_empty_table(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}


def test_one_part_without_failures_has_all_steps(spark):
    docs = [(1, " ".join(f"w{i}" for i in range(60)), "clean")]
    got = audited(spark, docs, [])
    assert len(got) == 600 and set(got.values()) == {(1, 0, 0, 0, 0, 0, 0)}
