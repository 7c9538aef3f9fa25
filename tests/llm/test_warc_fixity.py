import hashlib

import pytest

from hourgrid.llm import warc_fixity

PAGES = "page_id bigint, url string, html string"
ARCHIVE = "number bigint, offset bigint, bytes bigint, digest string"


def archive(spark, pages):
    table = spark.createDataFrame(pages, PAGES)
    return warc_fixity.laid_out(warc_fixity.hashed(warc_fixity.records(table)))


def audited(spark, one, two):
    a, b = (spark.createDataFrame(x, ARCHIVE) for x in (one, two))
    return sorted(map(tuple, warc_fixity.audit(a, b).collect()), key=str)


def size(page, url, html):
    body = (html or "").encode()
    name = "none" if page is None else page
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Date: {warc_fixity.DATE}\r\n"
    head += f"WARC-Target-URI: {url or ''}\r\n"
    return len(head.encode() + f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")


def brute(one, two):
    def entries(rows):
        out = {}
        for number, offset, bytes_, digest in rows:
            out.setdefault((number, offset), []).append((bytes_, digest))
        return {k: sorted(v) for k, v in out.items()}

    def side(key, held):
        return (len(held), key[1], sum(x for x, _ in held)) if held else (None, None, None)

    a, b = entries(one), entries(two)
    rows, gone, new = [], {}, {}
    for key in set(a) | set(b):
        if key in a and key in b:
            if a[key] != b[key]:
                rows.append((key[0], "altered", *side(key, a[key]), *side(key, b[key])))
        else:
            group = gone if key in a else new
            group.setdefault((key[0], str((a if key in a else b)[key])), []).append(key)
    for what in set(gone) | set(new):
        order = lambda k: (k[1] is not None, k[1] or 0)
        x, y = (sorted(g.get(what, []), key=order) for g in (gone, new))
        for i in range(max(len(x), len(y))):
            p, q = x[i] if i < len(x) else None, y[i] if i < len(y) else None
            status = "moved" if p and q else "missing" if p else "added"
            rows.append((what[0], status, *side(p, a.get(p)), *side(q, b.get(q))))
    return sorted(rows, key=str)


def rows_of(numbers, width=3000):
    return [(n, i * width, 100 + n % 7, hashlib.sha256(str(n).encode()).hexdigest()) for i, n in enumerate(numbers)]


BASE = rows_of(range(-40, 600, 3))


@pytest.mark.parametrize(
    "change",
    [
        lambda rows: rows,
        lambda rows: rows[::-1],
        lambda rows: [(n, o, b, "x") if n == 2 else (n, o, b, d) for n, o, b, d in rows],
        lambda rows: [(n, o, b + 1, d) if n in (-40, 299, 596) else (n, o, b, d) for n, o, b, d in rows],
        lambda rows: [r for r in rows if r[0] not in (5, 8, 500)],
        lambda rows: [r for r in rows if not 100 < r[0] < 400],
        lambda rows: [*rows, (1, 10**13, 5, "new"), (-(10**9), 3, 5, "far")],
        lambda rows: [*rows, rows[0], rows[0], rows[1]],
        lambda rows: [*rows, (None, None, 9, "q"), (None, None, 9, "q"), (None, 7, 9, "q"), (3, None, 9, "q")],
        # Two records change places, one moves far, one moves and changes, all shift behind a longer one.
        lambda rows: [(*rows[i ^ 1 if i < 20 else i][:1], rows[i][1], *rows[i ^ 1 if i < 20 else i][2:]) for i in range(len(rows))],
        lambda rows: [(n, o + 10**7, b, d) if n == 20 else (n, o + 1, b, "z") if n == 29 else (n, o, b, d) for n, o, b, d in rows],
        lambda rows: [(n, o + 10 if n > 300 else o, b, d) for n, o, b, d in rows],
        lambda rows: [],
    ],
)
def test_same_as_comparing_all_records(spark, change):
    other = change(BASE)
    assert audited(spark, BASE, other) == brute(BASE, other)
    assert audited(spark, other, BASE) == brute(other, BASE)


def test_repeated_records_that_move(spark):
    one = [(1, o, 5, "d") for o in (0, 10, 200_000)] + [(1, 10, 5, "d")]
    two = [(1, o, 5, "d") for o in (0, 20, 300_000, 400_000)]
    assert audited(spark, one, two) == brute(one, two)


def test_edge_cases(spark):
    assert audited(spark, [], []) == []
    nulls = [(None, None, 5, "d"), (None, 3, 5, "d"), (4, None, 5, "d")]
    assert audited(spark, nulls, nulls[::-1]) == [] and audited(spark, nulls, nulls[1:]) == brute(nulls, nulls[1:])
    extra = spark.createDataFrame([(1, 0, 5, "d", "x", "y")], f"{ARCHIVE}, node string, a string")
    assert warc_fixity.audit(extra, extra).count() == 0


def test_records_are_warc(spark):
    row = warc_fixity.records(spark.createDataFrame([(7, "http://u/é", "<p>é</p>")], PAGES), "2024-05-01T00:00:00Z").first()
    head, _, rest = bytes(row.record).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and "Content-Length: 9" in lines and "WARC-Date: 2024-05-01T00:00:00Z" in lines
    assert rest == "<p>é</p>".encode() + b"\r\n\r\n" and len(row.record) == size(7, "http://u/é", "<p>é</p>")


def test_records_lie_one_after_the_other(spark):
    pages = [(i, f"http://u/{i}", "text é " * (i % 7)) for i in range(-40, 600, 3)] + [(None, None, None), (5, "u", "x"), (5, "u", "x")]
    got = archive(spark, pages).orderBy("offset").collect()
    want = sorted((p is None, p or 0, size(p, u, h)) for p, u, h in pages)
    assert [(r.number is None, r.number or 0) for r in got] == [w[:2] for w in want]
    assert sorted(r.bytes for r in got) == sorted(w[2] for w in want)
    at = 0
    for r in got:
        assert r.offset == at
        at += r.bytes
    assert archive(spark, []).collect() == []


def test_only_branches_that_differ_are_read(spark):
    far = [(n, n << 20, 10, str(n)) for n in range(300)]
    a, b = (spark.createDataFrame(x, ARCHIVE) for x in (far, [(*r[:3], "bad") if r[0] == 123 else r for r in far]))
    levels = warc_fixity.height(a, b)
    assert 16 ** (levels + 1) << 12 >= 300 << 20 and levels == 4
    nodes = warc_fixity.compare(warc_fixity.merkle_tree(a, levels), warc_fixity.merkle_tree(b, levels)).collect()
    assert [tuple(n) for n in nodes] == [(False, (123 << 20) >> 16)]
