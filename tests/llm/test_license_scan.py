import random

import pytest

from brute import plain_words
from hourgrid.llm import license_scan

SCHEMA = "doc_id bigint, text string, labels int, matches string, n_words string"
FILLER = [f"word{i}" for i in range(40)] + ["the", "license", "public", "version", "under", "software", "cc"]


def brute(text, templates=license_scan.TEMPLATES, percent=90, block=64, step=32):
    w = plain_words(text)
    places = []
    for label, phrase in license_scan.PHRASES:
        p = phrase.split()
        places += [(s, label) for s in range(len(w)) if w[s : s + len(p)] == p]
    matches, s = [], 0
    while True:
        for t, (label, phrase) in enumerate(templates):
            own = set(plain_words(phrase))
            shared = len(own & set(w[s : s + block]))
            if own and 100 * shared >= percent * len(own):
                matches.append((label, t, s, shared, shared / len(own)))
        if s + block >= len(w):
            break
        s += step
    starts = [s for s, _ in places]
    return (
        len(w), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places}), matches
    )


def scanned(spark, texts, **how):
    table = spark.createDataFrame([(i, t, 1, "m", "n") for i, t in enumerate(texts)], SCHEMA)
    rows = license_scan.scan(table, **how).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return [(*tuple(r)[1:6], [tuple(m) for m in r.matches]) for r in rows]


def noisy(seed):
    draw = random.Random(seed)
    out = []
    for _ in range(60):
        w = [draw.choice(FILLER) for _ in range(draw.randrange(0, 400))]
        for _ in range(draw.randrange(3)):
            notice = draw.choice(license_scan.TEMPLATES)[1].split()
            if draw.random() < 0.4:
                notice[draw.randrange(len(notice))] = "changed"
            at = draw.randrange(len(w) + 1)
            w[at:at] = notice
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent,block,step", [(90, 64, 32), (60, 20, 7), (100, 40, 40), (30, 64, 32)])
def test_equals_every_block_against_every_template(spark, percent, block, step):
    texts = noisy(percent)
    want = [brute(t, percent=percent, block=block, step=step) for t in texts]
    assert sum(len(x[-1]) for x in want) > 20
    assert scanned(spark, texts, percent=percent, block=block, step=step) == want


def test_odd_texts(spark):
    texts = [None, "", "...", "MIT License", "mit\nlicense, MIT-License", "mit licenses", "ÉMIT license", "cc by cc by"]
    texts += ["Licensed under CC BY-NC 4.0.", "gnu general public license", "x " * 60 + "Released under the MIT License", "w" * 1_000_000]
    texts += ["a " * 300_000 + "apache license", texts[3]]
    got = scanned(spark, texts)
    assert got == [brute(t) for t in texts]
    assert got[3][4] == ["mit"] and got[6][4] == [] and {m[0] for m in got[8][5]} == {"cc-by-nc-4.0"}
    assert {m[0] for m in got[10][5]} == {"mit"}


def test_templates_as_parameter(spark):
    assert scanned(spark, ["a b c"], templates=[]) == [brute("a b c", [])]
    own = [("none", "..."), ("x", "b c"), ("y", "c b b")]
    known = [o for o in own if o[0] != "none"]
    assert scanned(spark, ["a b c"], templates=own) == [brute("a b c", known)]
    assert scanned(spark, []) == []
    with pytest.raises(ValueError, match="step"):
        license_scan.scan(spark.createDataFrame([], SCHEMA), block=4, step=5)
