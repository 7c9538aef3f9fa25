import hashlib
import random

import brute
import pytest

from hourgrid.llm import decontaminate

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def found(spark, docs, items, window=10, docs_schema=DOCS, items_schema=ITEMS):
    got = decontaminate.contamination(
        spark.createDataFrame(docs, docs_schema), spark.createDataFrame(items, items_schema), window
    ).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=str)


def wanted(docs, items, window=10):
    out = []
    for i, text in docs:
        n, hit, ids = brute.hits(text, items, window)
        out.append((i, n, hit, sorted(str(x) for x in ids if x is not None), hit > 0))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,window", [(1, 10), (2, 3), (3, 1)])
def test_same_as_all_windows(spark, seed, window):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(12)]
    docs = []
    for i in range(60):
        parts = [rng.choice(words) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.5:
            phrase = rng.choice(items)[1].upper().split()
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = phrase[rng.randrange(2) :]
        docs.append((i, rng.choice([" ", ", ", "\n--"]).join(parts)))
    assert found(spark, docs, items, window) == wanted(docs, items, window)


def test_edge_cases(spark):
    phrase = "one two three four five six seven eight nine ten eleven"
    items = [(3, phrase), (21, phrase), (21, phrase), (4, None), (5, " .,! "), (6, "lone"), (None, "nameless item"), (7, "É é")]
    long = ("filler " * 30_000) + phrase
    docs = [(1, f"x {phrase.upper()} y"), (1, f"x {phrase.upper()} y"), (2, None), (3, ""), (4, "a LONE wolf"), (None, "lone")]
    docs += [(5, "nameless, item"), (6, long), (7, phrase[:-7]), (8, "É é"), (9, "é é"), (1, "another text")]
    got = found(spark, docs, items)
    assert got == wanted(docs, items)
    assert (6, 30_011, 11, ["21", "3"], True) in got and (5, 2, 2, [], True) in got


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert found(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]


def test_clashing_columns(spark):
    extra = "key string, phrase string, term string, pos string, start string, _hit_key string"
    docs, items = [(1, "a b c", *"uvwxyz"), (2, None, *"uvwxyz")], [(9, "b c", *"uvwxyz")]
    got = found(spark, docs, items, docs_schema=f"{DOCS}, {extra}".replace(", _hit_key string", ", z string"), items_schema=f"{ITEMS}, {extra}")
    assert got == [(1, 3, 2, ["9"], True), (2, 0, 0, [], False)]


def test_contaminated_rows_go(spark):
    phrase = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"x {phrase}", "k"), (2, "clean", "k"), (None, phrase, "k"), (4, None, "k"), (2, "clean", "k")], f"{DOCS}, key string")
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, phrase)], ITEMS))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 2, 4]


def near_brute(docs, items, window, slop, percent):
    out = {}
    for i, text in docs:
        w = brute.plain_words(text)
        for item, phrase in items:
            v = brute.plain_words(phrase)
            last = max(len(v) - window, 0)
            for b in {*range(0, last + 1, window), last} if v else ():
                own = v[b : b + window]
                need = -(-percent * len(own) // 100)
                for s in range(len(w)):
                    n = sum(any(x == t for x in w[max(s + k - slop, 0) : max(s + k + slop + 1, 0)]) for k, t in enumerate(own))
                    if n >= need:
                        out[i, item] = max(out.get((i, item), 0), n)
    return out


def near(spark, docs, items, **how):
    got = decontaminate.proximity_matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **how).collect()
    assert len(got) == len({(r.doc_id, r.key, r.item_id) for r in got})
    return {(r.doc_id, r.item_id): r.n_places for r in got}


@pytest.mark.parametrize("window,slop,percent", [(10, 3, 80), (4, 1, 75), (6, 0, 100), (3, 2, 50)])
def test_proximity_with_changed_lost_and_moved_words(spark, window, slop, percent):
    rng = random.Random(window)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 33)))) for i in range(10)] + [(90, None), (91, "... "), (92, "rare")]
    docs = [(900, None), (901, ""), (902, "rare")]
    for i in range(50):
        own = rng.choice(items[:10])[1].split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(own))
            kind = rng.randrange(4)
            if kind == 0:
                own[at] = f"unseen{i}"
            elif kind == 1 and len(own) > 1:
                del own[at]
            elif kind == 2:
                own.insert(at, rng.choice(words))
            else:
                other = min(at + rng.randrange(3), len(own) - 1)
                own[at], own[other] = own[other], own[at]
        docs.append((i, " ".join([rng.choice(words) for _ in range(rng.randrange(12))] + own + [rng.choice(words) for _ in range(5)])))
    want = near_brute(docs, items, window, slop, percent)
    assert len(want) > 15 and near(spark, docs, items, window=window, slop=slop, percent=percent) == want


def test_a_changed_word_that_occurs_nowhere_and_three_words_of_ten(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, "x " + item.replace("five", "quux") + " y"), (2, "one two three and nothing else"), (3, item)]
    assert near(spark, docs, [(7, item)]) == {(1, 7): 9, (3, 7): 10}
    assert near(spark, docs, []) == near(spark, [], [(7, item)]) == {}


def test_no_python_in_the_plan(spark, tmp_path):
    docs, items = spark.createDataFrame([(1, "a b c")], DOCS), spark.createDataFrame([(9, "b c")], ITEMS)
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_query_digest(spark):
    from hourgrid.llm.queries import QUERIES

    row = QUERIES["op10_positional_index"](spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
