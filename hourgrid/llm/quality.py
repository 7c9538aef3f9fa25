"""Quality rules: base limits on text statistics, and robust multivariate outliers per language and source.

Statistics become a vector: the logarithm of the mean word length, and the angles asin(sqrt(p)) of the shares of symbol
characters, repeated words and repeated lines. For each group the minimum covariance determinant estimate is found by
concentration steps from deterministic starts: the mean and covariance of the `SUPPORT` nearest rows give new distances,
and so on until nothing moves; the start that ends with the smallest determinant wins. All rows that it accepts are then
weighed in once more. Rows beyond the chi-square quantile of the final estimate are rejected.

Most texts have no symbols and repeat nothing, so shares have two parts: zeros, and values whose scatter is that of the
accepted rows that have any. A statistic of a short text is noisy by itself: its deviation counts in units of the scatter
of the group or of the text's own sampling noise, whichever is larger. No scale is a constant.

Only DataFrame functions are used. A group is seen through sums and histograms of distances, which are partial before
their shuffle, so a source with a third of all rows costs no more than any other. Vectors are whole thousandths and
sums of them exact, so results do not depend on the order of rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import column_or_null, fresh, stage

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEATED_PERCENT = 50

#: Part of a group's rows that its estimate rests on.
SUPPORT = 0.75
#: Rows a group needs for an estimate of its own; smaller ones use that of their language, then of all rows.
GROUP_ROWS = 60
#: Concentration steps end when no estimate moves, or after so many.
STEPS = 12
#: Chi-square probability beyond which a clean vector of a normal group lies rarely.
CUTOFF_TAIL = 0.001
#: Sampling variance of each part of the vector: this number divided by a count of the text; for the word length, times the
#: relative variance of word lengths within the texts of the group. A share of independent units has 1 / (4 n) as an
#: angle; symbols come some 4 together, repeated words 12 (six words, twice), lines alone.
FEATURES = {
    "word_length": (1.0, "n_words"),
    "symbol_share": (1.0, "word_chars"),
    "repeat_share": (3.0, "n_words"),
    "line_share": (0.25, "n_lines"),
}
#: Parts that are zero in most texts.
SHARES = ("symbol_share", "repeat_share", "line_share")
#: Rows that the sampling noise counts as in the scatter of the values above zero.
PRIOR_ROWS = 10
UNIT = 1000
DISTANCE_BINS = 512


# Statistics of one text


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id, key, lang, source, n_words, word_chars, squares (of word lengths), n_symbols, n_lines, n_dup_lines,
    n_repeat_words of every row.

    Null and empty texts have no words; `lang` or `source` may be missing or null. Rows stay as often as they come.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        column_or_null(documents, "lang", "string").alias("lang"),
        column_or_null(documents, "source", "string").alias("source"),
        text.alias("t"),
        F.array_remove(F.split(text, SPACE + "+"), "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    triple = F.transform(
        F.sequence(F.lit(1), F.size("w") - 2),
        lambda i: F.xxhash64(F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)),
    )
    rows = rows.select("*", F.when(F.size("w") >= 3, triple).otherwise(F.array().cast("array<bigint>")).alias("g"))
    # Most texts repeat no three words: only the others are sorted.
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    ordered = F.array_sort(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select("*", F.when(repeats, ordered).alias("o"))

    def twice(x: Column, j: Column) -> Column:
        before = F.get("o", j - 1)["h"] == x["h"]
        after = F.get("o", j + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.array_sort(F.transform(F.filter("o", twice), lambda x: x["i"]))
    rows = rows.select("*", places.alias("p"))
    widths = F.transform("p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("p", j + 1) - x, F.lit(3))))
    covered = F.aggregate(widths, F.lit(0).cast("bigint"), lambda a, x: a + x)
    long = "bigint"
    lengths = F.transform("w", lambda x: F.length(x).cast(long))
    squares = F.aggregate(lengths, F.lit(0).cast(long), lambda a, x: a + x * x)
    return rows.select(
        "doc_id",
        "key",
        "lang",
        "source",
        F.size("w").cast(long).alias("n_words"),
        F.length(F.regexp_replace("t", SPACE + "+", "")).cast(long).alias("word_chars"),
        squares.alias("squares"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast(long).alias("n_symbols"),
        F.size("lines").cast(long).alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast(long).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast(long).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    """The parts of the vector in thousandths, their sampling variances, and the relative variance of word lengths in
    millionths; rows that fail the base rules may have none."""

    def angle(part: str, whole: str) -> Column:
        share = F.least(F.col(part) / F.col(whole), F.lit(1.0))
        return F.asin(F.sqrt(share))

    parts = {
        "word_length": F.log(F.col("word_chars") / F.col("n_words")),
        "symbol_share": angle("n_symbols", "word_chars"),
        "repeat_share": angle("n_repeat_words", "n_words"),
        "line_share": angle("n_dup_lines", "n_lines"),
    }
    values = [F.round(parts[name] * UNIT).cast("bigint").alias(name) for name in FEATURES]
    noise = [F.ceil(UNIT**2 * size / F.col(n)).cast("bigint").alias(f"v_{a}") for a, (size, n) in FEATURES.items()]
    relative = F.col("n_words") * F.col("squares") / (F.col("word_chars").cast("double") * F.col("word_chars")) - 1
    return [*values, *noise, F.round(UNIT**2 * F.greatest(relative, F.lit(0.0))).cast("bigint").alias("spread")]


# Estimates


def chi_square_tail(x: float, freedom: int) -> float:
    """Probability beyond x, for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= half / i
        total += term
    return math.exp(-half) * total


def chi_square_quantile(tail: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_tail(middle, freedom) > tail else (low, middle)
    return high


def consistency(support: float, freedom: int) -> float:
    """Factor by which the covariance of the nearest `support` of a normal sample is too small."""
    return support / (1 - chi_square_tail(chi_square_quantile(1 - support, freedom), freedom + 2))


def _moments(names: list[str]) -> list[Column]:
    """Exact sums of the vector's parts, their products and their sampling variances, and counts of values above zero."""
    wide = {n: F.col(n).cast("decimal(18,0)") for n in names}
    sums = [F.sum(wide[n]).alias(f"s_{n}") for n in names]
    products = [
        F.sum((wide[a] * wide[b]).cast("decimal(36,0)").cast("decimal(38,0)")).alias(f"s_{a}_{b}")
        for i, a in enumerate(names)
        for b in names[: i + 1]
    ]
    noise = [F.sum(f"v_{n}").alias(f"v_{n}") for n in names]
    above = [F.count_if(F.col(n) > 0).alias(f"n_{n}") for n in SHARES]
    return [F.count("*").alias("held"), *sums, *products, *noise, *above, F.sum("spread").alias("spread")]


def _noise(variance: Column, part: str, spread: Column) -> Column:
    """Sampling variance of a part, at least a unit of rounding."""
    return F.greatest(variance if part in SHARES else variance * spread, F.lit(1.0))


def _estimate(sums: DataFrame, keys: list[str], names: list[str], factor: float, two_parts: bool = False) -> DataFrame:
    """keys, means, deviations, the Cholesky factor of the covariance, mean sampling variances, and the log determinant.

    Variances are at least one unit of rounding, those of shares at least the mean sampling variance. With `two_parts`,
    those of shares are the mean square of the values above zero, the sampling variance counting as `PRIOR_ROWS` of them.
    """
    n = F.col("held").cast("double")
    means = {a: F.col(f"s_{a}").cast("double") / n for a in names}
    spread = F.col("spread") / n / UNIT**2
    noise = {a: _noise(F.col(f"v_{a}") / n, a, spread) for a in names}
    least = {a: noise[a] if a in SHARES else F.lit(1.0) for a in names}
    if two_parts:
        for a in SHARES:
            squares = F.col(f"s_{a}_{a}").cast("double")
            least[a] = (squares + PRIOR_ROWS * noise[a]) / (F.col(f"n_{a}") + PRIOR_ROWS)
    covariance = {
        (a, b): factor * (F.col(f"s_{a}_{b}").cast("double") / n - means[a] * means[b])
        for i, a in enumerate(names)
        for b in names[: i + 1]
    }
    out = sums.select(
        *keys,
        "held",
        spread.alias("k"),
        *(means[a].alias(f"m_{a}") for a in names),
        *(noise[a].alias(f"f_{a}") for a in names),
        *((F.greatest(c, least[a]) if a == b else c).alias(f"c_{a}_{b}") for (a, b), c in covariance.items()),
    )
    out = out.withColumns({f"d_{a}": F.sqrt(f"c_{a}_{a}") for a in names})
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            known = [F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}") for c in names[:j]]
            rest = reduce(lambda x, y: x - y, known, F.col(f"c_{a}_{b}"))
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if a == b else rest / F.col(f"l_{b}_{b}")
            out = out.withColumn(f"l_{a}_{b}", value)
    det = reduce(lambda x, y: x + y, [2 * F.log(F.col(f"l_{a}_{a}")) for a in names])
    factors = [f"l_{a}_{b}" for i, a in enumerate(names) for b in names[: i + 1]]
    shown = ["k", *(f"{x}_{a}" for x in "mfd" for a in names)]
    return out.select(*keys, "held", *shown, *factors, det.alias("det"))


def distance(names: list[str], noisy: bool = False) -> Column:
    """Squared Mahalanobis distance, by forward substitution.

    With `noisy`, parts whose sampling deviation exceeds that of the group count in units of the former.
    """
    solved: dict[str, Column] = {}
    for i, a in enumerate(names):
        rest = F.col(a) - F.col(f"m_{a}")
        if noisy:
            rest = rest * F.least(F.lit(1.0), F.col(f"d_{a}") / F.sqrt(_noise(F.col(f"v_{a}"), a, F.col("k"))))
        for b in names[:i]:
            rest = rest - F.col(f"l_{a}_{b}") * solved[b]
        solved[a] = rest / F.col(f"l_{a}_{a}")
    return reduce(lambda x, y: x + y, [v * v for v in solved.values()])


def _columns(names: list[str]) -> list[str]:
    return [*names, *(f"v_{a}" for a in names), "spread"]


def _nearest(rows: DataFrame, estimates: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The rows of each group whose distance bin lies in the nearest `SUPPORT` of the group."""
    bin_ = F.floor(F.log2(1 + distance(names)) * DISTANCE_BINS).alias("bin")
    placed = rows.join(estimates, keys).select(*keys, *_columns(names), bin_)
    histogram = placed.groupBy(*keys, "bin").agg(F.count("*").alias("c"))
    group = Window.partitionBy(*keys)
    run = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = histogram.select(*keys, "bin", F.sum("c").over(run).alias("upto"), F.sum("c").over(group).alias("all"))
    limits = summed.where(F.col("upto") >= F.ceil(F.col("all") * SUPPORT)).groupBy(*keys).agg(F.min("bin").alias("limit"))
    return placed.join(limits, keys).where("bin <= limit")


def _first_estimates(rows: DataFrame, names: list[str], factor: float) -> DataFrame:
    """Two starts per group: mean and covariance of all rows; median and sampling deviations."""
    whole = _estimate(rows.groupBy("group").agg(*_moments(names)), ["group"], names, 1.0)
    whole = whole.withColumn("start", F.lit("mean"))
    long = rows.select(
        "group", F.explode(F.array(*(F.struct(F.lit(a).alias("name"), F.col(a).alias("value")) for a in names))).alias("x")
    )
    counts = long.groupBy("group", "x.name", "x.value").agg(F.count("*").alias("c"))
    group = Window.partitionBy("group", "name")
    run = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select("group", "name", "value", F.sum("c").over(run).alias("upto"), F.sum("c").over(group).alias("all"))
    middle = summed.where("2 * upto >= all").groupBy("group", "name").agg(F.min("value").alias("value"))
    middle = middle.groupBy("group").pivot("name", names).agg(F.first("value"))
    zero = F.lit(0.0)
    medians = whole.select("group", "k", *(f"f_{a}" for a in names)).join(middle, "group").select(
        "group",
        F.lit(0).cast("bigint").alias("held"),
        "k",
        *(F.col(a).cast("double").alias(f"m_{a}") for a in names),
        *(F.col(f"f_{a}") for a in names),
        *(F.sqrt(f"f_{a}").alias(f"d_{a}") for a in names),
        *(
            (F.sqrt(f"f_{a}") if a == b else zero).alias(f"l_{a}_{b}")
            for i, a in enumerate(names)
            for b in names[: i + 1]
        ),
        zero.alias("det"),
        F.lit("median").alias("start"),
    )
    return whole.unionByName(medians)


def _group(level: str) -> Column:
    """Key of a row's group at a level; nulls are a value of their own."""
    parts = {"source": ["lang", "source"], "lang": ["lang"], "all": []}[level]
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in parts]
    return F.to_json(F.array(F.lit(level), *marked))


def cutoff() -> float:
    return chi_square_quantile(CUTOFF_TAIL, len(FEATURES))


def estimates(vectors: DataFrame) -> DataFrame:
    """(lang, source, group) with means, factor and determinant of the estimate that each group uses."""
    names = list(FEATURES)
    factor = consistency(SUPPORT, len(names))
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    in_language = F.sum("rows").over(Window.partitionBy("lang"))
    sizes = sizes.select("lang", "source", "rows", in_language.alias("language_rows"))
    level = F.when(F.col("rows") >= GROUP_ROWS, _group("source")).when(
        F.col("language_rows") >= GROUP_ROWS, _group("lang")
    )
    uses = stage(sizes.select("lang", "source", F.coalesce(level, _group("all")).alias("group")), "uses")
    levels = F.explode(F.array(*(_group(x) for x in ("source", "lang", "all")))).alias("group")
    rows = vectors.select(levels, *_columns(names)).join(uses.select("group").distinct(), "group", "left_semi")
    rows = stage(rows, "vectors")

    current = stage(_first_estimates(rows, names, factor), "estimates")
    keys = ["group", "start"]
    both = rows.select("*", F.explode(F.array(F.lit("mean"), F.lit("median"))).alias("start"))
    for _ in range(STEPS):
        sums = _nearest(both, current, keys, names).groupBy(*keys).agg(*_moments(names))
        before, current = current, stage(_estimate(sums, keys, names, factor), "estimates")
        earlier = before.select(*keys, F.col("det").alias("earlier"))
        if current.join(earlier, keys).where("abs(det - earlier) > 1e-9").isEmpty():
            break
    best = current.groupBy("group").agg(F.min(F.struct("det", "start")).alias("b")).select("group", "b.start")
    raw = current.join(best, keys).drop("start", "held")
    accepted = rows.join(raw, "group").where(distance(names, noisy=True) <= cutoff())
    sums = accepted.groupBy("group").agg(*_moments(names))
    final = _estimate(sums, ["group"], names, consistency(1 - CUTOFF_TAIL, len(names)), two_parts=True)
    return uses.join(stage(final.drop("held"), "estimates"), "group")


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, key, statistics, base_failed, distance (squared) and kept; one row per input row.

    Texts below `MIN_WORDS` words, null and empty ones among them, and texts that mostly repeat themselves fail the base
    rules. Groups of fewer than `GROUP_ROWS` other rows use the estimate of their language, or of all rows. Null lang
    and source are groups of their own. Repeated rows count each and get the same verdict. Other columns are ignored.
    An empty table gives no rows.
    """
    counted = statistics(documents).withColumn("base_failed", base_failed())
    names = list(FEATURES)
    parts = [
        F.when(~F.col("base_failed"), part).alias(name) for name, part in zip(_columns(names), _vector(), strict=True)
    ]
    counted = stage(counted.select("*", *parts), "statistics")
    found = estimates(counted.where("not base_failed")).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    far = F.when(~F.col("base_failed"), distance(names, noisy=True))
    scored = counted.join(found, same, "left").withColumn("distance", far)
    near = F.col("distance") <= cutoff()
    kept = ~F.col("base_failed") & F.coalesce(near, F.lit(True))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    return scored.select("doc_id", "key", *shown, kept.alias("kept"))


#: Rejected rows (16 bytes) up to this number are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that are kept, as they are."""
    hit_id, hit_key = fresh(documents, "hit_id", "hit_key")
    rejected = judge(documents).where("not kept").select(F.col("doc_id").alias(hit_id), F.col("key").alias(hit_key))
    rejected = stage(rejected.distinct(), "rejected")
    few = rejected.count() <= BROADCAST_ROWS
    same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.xxhash64("text") == F.col(hit_key))
    return documents.join(F.broadcast(rejected) if few else rejected, same, "left_anti")
