"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Mail addresses, phone numbers, network addresses, payment cards, bank accounts, identity numbers and names after a title
are found by patterns. Every distinct value gets a surrogate from a keyed hash, so it is the same wherever the value
stands. The words of a name are values of their own, whatever their case; in a text that names someone with a title,
every further capitalised mention of one of these words is replaced as well, with or without a title. Checks over the
distinct values make sure that no two values share a surrogate and that none is itself a value of the data: the values
concerned take the next attempt. After some attempts surrogates grow, so there always is a free one.

Only DataFrame functions are used. Texts are rewritten where they are read; only values that needed a further attempt
are joined, to the texts that hold them, and only texts with names are taken apart into words. Patterns repeat groups a
bounded number of times, so no text makes them recurse; a mail address may have up to 126 labels.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import fresh, stage

# Titles by gender, most used languages first.
MALE = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Господин", "г-н", "Κύριος", "Κος")
NEUTRAL = ("Dr", "Doctor", "Prof", "Professor", "Rev", "Mx", "Доктор", "Профессор", "Δρ")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Srta", "Madame", "Mme", "Mlle", "Госпожа", "г-жа", "Κυρία", "Κα")

TITLES = sorted(MALE + FEMALE + NEUTRAL, key=lambda t: (-len(t), t))
_TITLES = "|".join(TITLES)
_LETTER = r"[\p{L}\p{M}'’-]"
_WORD = rf"\p{{Lu}}{_LETTER}+"
#: Where a run of letters begins or ends.
EDGE = rf"(?<={_LETTER})(?!{_LETTER})|(?<!{_LETTER})(?={_LETTER})"
POSSESSIVE = r"['’][sS]?$"
PATTERNS = {
    "mail": r"(?<![\w.+%-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}(?![\w-])",
    "account": r"(?<![\w-])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])",
    "address": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\w]|\.[0-9])",
    "card": r"(?<![\w.+-])(?:(?:4[0-9]{3}|5[1-5][0-9]{2}|2[2-7][0-9]{2}|35[0-9]{2}|6[045][0-9]{2})(?:[ -]?[0-9]{4}){3}"
    r"|4[0-9]{12}(?:[0-9]{6})?|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|3[068][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{4})(?![\w-])",
    "identity": r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w.+-])(?:(?:\+1 ?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}|\+[0-9]{8,15})(?![\w-])",
    "name": rf"(?<![\w-])(?:{_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}",
}
ANY = "|".join(PATTERNS.values())
#: Texts without this have nothing to find; it costs a fraction of the patterns.
HINT = rf"[@0-9]|(?=[{''.join(sorted({t[0] for t in TITLES}))}])(?:{_TITLES})\.? \p{{Lu}}"
#: Attempts in the exact shape of the value; further ones use more digits or letters, so no space is ever full.
SHAPED = 8

#: Parts that stay as they are.
KEPT = ("title", "other")

#: Syllables of made-up names by script (fixed values), and their endings by gender.
SCRIPTS = {
    "latin": ("b d f g k l m n p r s t v z br tr".split(), "a e i o u ai ei ou".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у я ю э".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ".split(), "α ε η ι ο υ ω ου".split()),
}
ENDINGS = {
    "latin": {"male": "n", "female": "na", "given": "l", "family": "r"},
    "cyrillic": {"male": "н", "female": "на", "given": "ль", "family": "р"},
    "greek": {"male": "ος", "female": "ια", "given": "ι", "family": "ης"},
}
#: Kinds of the words of a name; a word that is a given name anywhere in a text is one in all of it.
NAME_KINDS = ("male", "female", "given", "family")


def spans(text: Column) -> Column:
    """All detected strings in order of place."""
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def kind_of(value: Column) -> Column:
    """What a detected string is; `other` if its check digits show that it is no card or account number after all."""
    # The patterns look around themselves, so a string is told by its shape alone.
    return (
        F.when(value.contains("@"), "mail")
        .when(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "address")
        .when(value.rlike(r"^[A-Z]{2}[0-9]{2}"), F.when(_account_rest(value) == 1, "account").otherwise("other"))
        .when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "identity")
        .when(value.rlike("^[0-9]([ -]?[0-9]){12,18}$"), F.when(_luhn(value) == 0, "card").otherwise("other"))
        .when(value.rlike(r"^[+(0-9]"), "phone")
        .otherwise("name")
    )


def stem(word: Column) -> Column:
    """A name's word in small letters, without the ending of a possessive."""
    return F.lower(F.regexp_replace(word, POSSESSIVE, ""))


def parts_of(value: Column) -> Column:
    """array<struct<kind, value>>: a name gives its title and words in small letters, anything else itself."""
    words = F.split(value, " ")
    title = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    gender = F.when(title.isin(*FEMALE), "female").when(title.isin(*MALE), "male").otherwise("given")
    given = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i == 0, "title").when(i == F.size(words) - 1, "family").otherwise(gender).alias("kind"), stem(w).alias("value")
        ),
    )
    alone = F.array(F.struct(kind_of(value).alias("kind"), value.alias("value")))
    return F.when(kind_of(value) == "name", given).otherwise(alone)


# Surrogates


def _digits(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that the key, the kind, the value and the attempt decide."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, value, attempt.cast("string")), 512)


def _draw(hexes: Column, at: Column, below: Column | int) -> Column:
    """A number below `below` from the four digits at place `at`."""
    start = F.pmod(at * 3, F.lit(124)).cast("int") + 1
    return F.pmod(F.conv(F.substr(hexes, start, F.lit(4)), 16, 10).cast("int"), F.lit(below) if isinstance(below, int) else below)


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _like(value: Column, hexes: Column) -> Column:
    """Digit for digit, small for small and capital for capital letter; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        small = F.substr(F.lit(_LOWER), _draw(hexes, i, 26) + 1, F.lit(1))
        return (
            F.when(c.rlike("^[0-9]$"), _draw(hexes, i, 10).cast("string"))
            .when(c.rlike(r"^\p{Ll}$"), small)
            .when(c.rlike(r"^\p{Lu}$"), F.upper(small))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _mail(value: Column, hexes: Column) -> Column:
    """The top domain stays, so the address still is one."""
    top = F.regexp_extract(value, r"\.[A-Za-z]+$", 0)
    return F.concat(_like(F.regexp_replace(value, r"\.[A-Za-z]+$", ""), hexes), top)


def _address(value: Column, hexes: Column) -> Column:
    """Four numbers of as many digits each, in range."""

    def one(part: Column, i: Column) -> Column:
        size = F.length(part)
        drawn = F.when(size == 1, _draw(hexes, i, 10)).when(size == 2, 10 + _draw(hexes, i, 90)).otherwise(
            100 + _draw(hexes, i, 156)
        )
        return drawn.cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), one), ".")


def _long_address(hexes: Column) -> Column:
    """An address of the next version of the protocol, in its range for examples."""
    groups = [F.substring(hexes, 4 * i + 1, 4) for i in range(6)]
    return F.concat_ws(":", F.lit("2001:db8"), *groups)


def _pattern(kind: Column, value: Column, attempt: Column) -> Column:
    """What a surrogate is shaped after: the value, with more room from attempt `SHAPED` on."""
    more = attempt - SHAPED + 4
    wide = (
        F.when(kind == "mail", F.concat(F.substring_index(value, "@", 1), F.repeat(F.lit("a"), more), F.lit("@"), F.substring_index(value, "@", -1)))
        .when(kind == "address", F.lit("100.100.100.100"))
        .otherwise(F.concat(value, F.repeat(F.lit("0"), more)))
    )
    return F.when(attempt < SHAPED, value).otherwise(wide)


def _luhn(number: Column) -> Column:
    """Check sum of a number's digits, 0 if valid."""
    digits = F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), "")

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.pmod(F.aggregate(F.transform(digits, one), F.lit(0), lambda a, x: a + x), F.lit(10))


def _card(value: Column, hexes: Column) -> Column:
    """The issuer's digits stay, and the check digit fits the rest."""
    issuer = F.when(value.startswith("4"), 1).otherwise(4)
    drawn = F.concat(F.substr(value, F.lit(1), issuer), F.substr(_like(value, hexes), issuer + 1))
    body = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    return F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))


def _account_rest(value: Column) -> Column:
    """Remainder by 97 of an account number with its first four characters last, 1 if valid."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10).cast("int"))
    return F.aggregate(values, F.lit(0), lambda a, x: F.pmod(F.when(x > 9, a * 100 + x).otherwise(a * 10 + x), F.lit(97)))


def _account(value: Column, hexes: Column) -> Column:
    """Country stays; the check digits fit the rest."""
    country, tail = F.substring(value, 1, 2), F.substr(_like(value, hexes), F.lit(5))
    rest = _account_rest(F.concat(country, F.lit("00"), tail))
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), tail)


def _phone(value: Column, hexes: Column) -> Column:
    """The country code stays; no group starts with 0 or 1 that did not before."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substr(value, F.length(code) + 1)
    drawn = _like(rest, hexes)
    starts = F.transform(
        F.split(drawn, ""),
        lambda c, i: F.when(
            c.rlike("^[01]$") & F.substr(rest, i + 1, F.lit(1)).rlike("^[2-9]$") & ~F.substr(rest, F.greatest(i, F.lit(1)), F.lit(1)).rlike("^[0-9]$"),
            (2 + _draw(hexes, i + 50, 8)).cast("string"),
        ).otherwise(c),
    )
    return F.concat(code, F.array_join(starts, ""))


def _name(kind: Column, value: Column, hexes: Column, attempt: Column) -> Column:
    """A made-up name of the script and gender in small letters; further attempts make it longer."""
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def made(name: str) -> Column:
        heads, vowels = (F.array(*map(F.lit, x)) for x in SCRIPTS[name])
        syllables = F.transform(
            F.sequence(F.lit(0), F.least(2 + F.floor(attempt / 2).cast("int"), F.lit(14))),
            lambda i: F.concat(
                F.element_at(heads, _draw(hexes, 2 * i, 16) + 1), F.element_at(vowels, _draw(hexes, 2 * i + 1, 8) + 1)
            ),
        )
        ending = F.lit(None).cast("string")
        for k, e in ENDINGS[name].items():
            ending = F.when(kind == k, e).otherwise(ending)
        return F.concat(F.array_join(syllables, ""), ending)

    return F.when(script == "cyrillic", made("cyrillic")).when(script == "greek", made("greek")).otherwise(made("latin"))


def _shaped(key: str, kind: Column, value: Column, attempt: Column, shape: Column) -> Column:
    hexes = _digits(key, kind, value, attempt)
    return (
        F.when(kind.isin(*KEPT), value)
        .when(kind == "mail", _mail(shape, hexes))
        .when((kind == "address") & (attempt >= 2 * SHAPED), _long_address(hexes))
        .when(kind == "address", _address(shape, hexes))
        .when(kind == "card", _card(shape, hexes))
        .when(kind == "account", _account(shape, hexes))
        .when(kind == "phone", _phone(shape, hexes))
        .when(kind == "identity", _like(shape, hexes))
        .otherwise(_name(kind, value, hexes, attempt))
    )


def surrogate(key: str, kind: Column, value: Column, attempt: Column | int) -> Column:
    if isinstance(attempt, int):
        if attempt < SHAPED:
            return _shaped(key, kind, value, F.lit(attempt), value)
        attempt = F.lit(attempt)
    # One evaluation of the shape, which is used many times.
    once = F.array(F.struct(attempt.alias("attempt"), _pattern(kind, value, attempt).alias("shape")))
    return F.element_at(F.transform(once, lambda x: _shaped(key, kind, value, x["attempt"], x["shape"])), 1)


# The table of values


def values_of(documents: DataFrame) -> DataFrame:
    """Distinct (kind, value) of all texts."""
    found = documents.select(F.explode(spans(F.col("text"))).alias("span")).groupBy("span").count().select("span")
    parts = found.select(F.explode(parts_of(F.col("span"))).alias("p")).select("p.kind", "p.value")
    return parts.where(~F.col("kind").isin(*KEPT)).distinct()


def attempts_of(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) of the values whose first surrogate is taken.

    Of values with the same surrogate the smallest keeps it. A value moves on while its surrogate is a value of the data
    or kept by another value. Names of all kinds share one space, so that no name stands for two people. From attempt
    `SHAPED` on every attempt has at least ten times the room of the one before (addresses: 156^4, then 16^24), so even
    values that fill their shape are settled after a few more.
    """
    space = F.when(F.col("kind").isin(*NAME_KINDS), "name").otherwise(F.col("kind"))
    real = values.select(space.alias("space"), F.col("value").alias("surrogate")).distinct()
    waiting = values.withColumn("attempt", F.lit(0))
    kept = None
    for attempt in count():
        made = surrogate(key, F.col("kind"), F.col("value"), attempt)
        tried = waiting.select("kind", "value", F.lit(attempt).alias("attempt"), space.alias("space"), made.alias("surrogate"))
        first = F.row_number().over(Window.partitionBy("space", "surrogate").orderBy("kind", "value"))
        tried = stage(tried.withColumn("place", first), "tried")
        free = tried.where("place = 1").join(real, ["space", "surrogate"], "left_anti")
        free = free.join(kept.select("space", "surrogate"), ["space", "surrogate"], "left_anti") if kept is not None else free
        free = stage(free, "free")
        kept = free if kept is None else kept.unionByName(free)
        waiting = stage(tried.join(free.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value"), "waiting")
        if waiting.isEmpty():
            return kept.where("attempt > 0").select("kind", "value", "attempt")


def _rewritten(text: Column, found: Column, made) -> Column:
    """`text` with each detected string but names replaced by what `made` gives for its kind and value."""
    between = F.split(text, ANY, -1)
    new = F.transform(found, lambda s: F.when(kind_of(s).isin("name", "other"), s).otherwise(made(kind_of(s), s)))
    # Zipped: inside a lambda function the other list would be made anew for every piece.
    return F.array_join(F.zip_with(between, new, lambda b, n: F.concat(b, F.coalesce(n, F.lit("")))), "")


def _like_case(word: Column, name: Column) -> Column:
    """The name in capitals if the word is, with the word's possessive ending."""
    bare = F.regexp_replace(word, POSSESSIVE, "")
    capital = bare.rlike(r"^[^\p{Ll}]{2,}$")
    return F.concat(F.when(capital, F.upper(name)).otherwise(F.initcap(name)), F.regexp_extract(word, POSSESSIVE, 0))


def _named_texts(texts: DataFrame, moved: DataFrame, key: str) -> DataFrame:
    """(id, text, n): texts (id, text, found, later) with names replaced wherever their words stand, and how many were.

    The words of a text meet the names of that text by an equality of (id, word), so neither many names nor long texts
    meet each other pair by pair.
    """
    rank = F.array_position(F.array(*map(F.lit, NAME_KINDS)), F.col("p.kind"))
    parts = texts.select("id", F.explode("found").alias("span")).where(kind_of(F.col("span")) == "name")
    parts = parts.select("id", F.explode(parts_of(F.col("span"))).alias("p")).where(F.col("p.kind") != "title")
    parts = parts.groupBy("id", F.col("p.value").alias("value")).agg(F.min(rank).cast("int").alias("rank"))
    parts = parts.withColumn("kind", F.element_at(F.array(*map(F.lit, NAME_KINDS)), F.col("rank")))
    parts = parts.join(moved, ["kind", "value"], "left").select(
        "id", "value", surrogate(key, F.col("kind"), F.col("value"), F.coalesce("attempt", F.lit(0))).alias("name")
    )
    plain = _rewritten(F.col("text"), F.col("found"), lambda kind, value: _again(key, F.col("later"), kind, value))
    words = texts.select("id", F.posexplode(F.split(plain, EDGE, -1)).alias("pos", "word"))
    words = words.withColumn("value", F.when(F.col("word").rlike(r"^\p{Lu}"), stem(F.col("word"))))
    new = words.join(parts, ["id", "value"], "left").select(
        "id", "pos", F.when(F.col("name").isNotNull(), _like_case(F.col("word"), F.col("name"))).otherwise(F.col("word")).alias("word"),
        F.col("name").isNotNull().alias("replaced"),
    )
    joined = new.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"), F.count_if("replaced").cast("int").alias("names")
    )
    whole = F.array_join(F.transform("words", lambda w: w["word"]), "")
    return joined.select("id", whole.alias("text"), F.col("names").alias("n"))


def _again(key: str, later: Column, kind: Column, value: Column) -> Column:
    """The surrogate of a value by the attempt that `later` lists for it."""
    attempt = F.coalesce(F.try_element_at(later, F.concat_ws("\u0001", kind, value)), F.lit(0))
    return surrogate(key, kind, value, attempt)


def replace(documents: DataFrame, key: str, count_column: str = "n_entities") -> DataFrame:
    """`documents` with surrogates in `text`, and `count_column`, the number of strings replaced.

    A name after a title is one string; each further mention of its words is another. Texts without personal data, empty and
    null ones stay as they are (null with 0 entities), and all other columns too, whatever their names. Long numbers whose
    check digits are wrong are no cards or accounts and stay. Repeated rows stay repeated and alike. An empty table
    gives no rows. A column that is named as `count_column` already is replaced.
    """
    names = [c for c in documents.columns if c not in ("text", count_column)]
    values = stage(values_of(documents), "values")
    moved = stage(attempts_of(values, key), "moved")
    id_, found_, later_ = fresh(documents, "text_id", "found", "later")
    found = spans(F.col("text"))
    base = documents.select(*names, "text", found.alias(found_))

    def shown(df: DataFrame, made) -> DataFrame:
        text = F.when(F.size(found_) > 0, _rewritten(F.col("text"), F.col(found_), made)).otherwise(F.col("text"))
        count = F.size(F.filter(found_, lambda s: kind_of(s) != "other"))
        return df.select(*names, text.alias("text"), count.alias(count_column))

    def first(df: DataFrame) -> DataFrame:
        return shown(df, lambda kind, value: surrogate(key, kind, value, 0))

    with_names = not values.where(F.col("kind").isin(*NAME_KINDS)).isEmpty()
    if moved.isEmpty() and not with_names:
        return first(base)
    # Texts that hold a moved value or a name, by hash; the others need no join.
    parts = documents.select(F.xxhash64("text").alias("id"), F.explode(found).alias("span"))
    parts = parts.select("id", F.explode(parts_of(F.col("span"))).alias("p")).select("id", "p.kind", "p.value").distinct()
    later = parts.join(moved, ["kind", "value"]).groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\u0001", "kind", "value"), "attempt"))).alias("later")
    )
    later = stage(later, "later")
    out = []
    if with_names:
        # A pattern of its own tells quickly which texts may hold names.
        may = F.coalesce(F.col("text").rlike(PATTERNS["name"]), F.lit(False))
        named = base.where(may).withColumn(id_, F.xxhash64("text"))
        texts = named.select(F.col(id_).alias("id"), "text", F.col(found_).alias("found")).dropDuplicates(["id"])
        texts = stage(_named_texts(stage(texts.join(later, "id", "left"), "named"), moved, key), "renamed")
        texts = texts.select(F.col("id").alias(id_), F.col("text").alias(later_), F.col("n").alias(count_column))
        inside = F.transform(F.filter(found_, lambda s: kind_of(s) == "name"), lambda s: F.size(parts_of(s)) - 2)
        count = F.size(F.filter(found_, lambda s: kind_of(s) != "other"))
        single = F.size(F.filter(found_, lambda s: kind_of(s) == "name"))
        extra = F.col(count_column) - F.aggregate(inside, F.lit(0), lambda a, x: a + x) - single
        out.append(named.join(texts, id_).select(*names, F.col(later_).alias("text"), (count + extra).alias(count_column)))
        base = base.where(~may)
    if moved.isEmpty():
        return reduce(DataFrame.unionByName, [first(base), *out])
    keyed = base.withColumn(id_, F.xxhash64("text"))
    held = later.select(F.col("id").alias(id_), F.col("later").alias(later_))
    out.append(shown(keyed.join(held, id_), lambda kind, value: _again(key, F.col(later_), kind, value)))
    return reduce(DataFrame.unionByName, [first(keyed.join(held.select(id_), id_, "left_anti")), *out])
