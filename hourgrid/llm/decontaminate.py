"""Benchmark passages in training documents, by a positional inverted index.

The benchmark's phrases are windows of consecutive words. Training tokens are counted for the words of the benchmark;
postings (term, document, position) are stored in the shared folder for the rarest terms of each phrase. A phrase starts
from the list of its rarest term, shifted by the term's place in the phrase, and is intersected with the shifted lists
of the next rarest ones; what remains is compared word by word with the document. Matches by proximity
(`proximity_matches`) look up the rarest places of a block of words and count how many of them stand near their places.

Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import fresh, stage

#: Lists that are intersected before a phrase is compared as a whole.
LISTS = 3
#: Document keys (16 bytes) up to this number are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _keyed(documents: DataFrame) -> DataFrame:
    """doc_id, key, text: rows alike in doc_id and text have the same results and need not be told apart."""
    return documents.select("doc_id", F.xxhash64("text").alias("key"), "text")


def phrases_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(phrase, words, item_id): all windows of an item; an item of fewer words is one phrase."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("s")
    cut = items.select("item_id", "w", starts).select("item_id", F.slice("w", F.col("s"), window).alias("words"))
    return cut.select(F.md5(F.concat_ws(" ", "words").cast("binary")).alias("phrase"), "words", "item_id").distinct()


def term_counts(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, seen): how often each of `terms` occurs in the texts; absent ones are not listed."""
    tokens = documents.select(F.explode(words_of(F.col("text"))).alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("seen"))


def postings(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, key, pos) of all occurrences of `terms`."""
    tokens = _keyed(documents).select("doc_id", "key", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return tokens.join(terms, "term", "left_semi").select("term", "doc_id", "key", "pos").distinct()


def probes_of(phrases: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, rank, term, shift): the rarest places of each phrase. Phrases with an absent term are left out.

    A phrase of fewer words than lists repeats its last place.
    """
    places = phrases.select("phrase", "words").distinct().select("phrase", F.posexplode("words").alias("shift", "term"))
    known = places.join(counts, "term", "left").groupBy("phrase").agg(
        F.sort_array(F.collect_list(F.struct("seen", "term", "shift"))).alias("places"),
        F.count_if(F.col("seen").isNull()).alias("absent"),
    )
    ranks = F.explode(F.sequence(F.lit(1), F.lit(lists))).alias("rank")
    chosen = known.where("absent = 0").select("phrase", "places", ranks)
    place = F.element_at("places", F.least("rank", F.size("places")))
    return chosen.select("phrase", "rank", place["term"].alias("term"), place["shift"].alias("shift"))


def intersect(index: DataFrame, probes: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, doc_id, key, start): where the probed terms of a phrase stand at their places."""
    first = index.join(probes.where("rank = 1"), "term")
    found = first.select("phrase", "doc_id", "key", (F.col("pos") - F.col("shift")).alias("start"))
    for rank in range(2, lists + 1):
        probe = probes.where(F.col("rank") == rank).select("phrase", "term", "shift")
        placed = found.join(probe, "phrase").select("phrase", "term", "doc_id", "key", "start", "shift")
        placed = placed.withColumn("pos", F.col("start") + F.col("shift"))
        same = F.col("p.doc_id").eqNullSafe(F.col("i.doc_id"))
        for c in ("term", "key", "pos"):
            same = same & (F.col(f"p.{c}") == F.col(f"i.{c}"))
        found = placed.alias("p").join(index.alias("i"), same, "left_semi").select("phrase", "doc_id", "key", "start")
    return found.where("start >= 0")


def search(documents: DataFrame, phrases: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, doc_id, key, start) of the index matches of `phrases`; exact on the `lists` rarest terms of a phrase."""
    terms = stage(phrases.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = stage(term_counts(documents, terms), "counts")
    probes = stage(probes_of(phrases, counts, lists), "probes")
    index = stage(postings(documents, stage(probes.select("term").distinct(), "probed")), "postings")
    return intersect(index, probes, lists)


def _texts_of(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, key, w): the words of the documents that `found` names, each once."""
    keys = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    few = keys.count() <= BROADCAST_KEYS
    texts = _keyed(documents).join(F.broadcast(keys) if few else keys, _same("doc_id", "key", "_id", "_key"), "left_semi")
    return texts.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", words_of(F.col("text")).alias("w"))


def _with_words(documents: DataFrame, found: DataFrame) -> DataFrame:
    """`found` (doc_id, key, ...) with the words `w` of its documents; the words of a document are shuffled once."""
    texts = _texts_of(documents, found)
    found = found.withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    return texts.join(found, _same("doc_id", "key", "_id", "_key")).drop("_id", "_key")


def phrase_matches(documents: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, key, phrase, start, length): exact occurrences of `phrases`, whose name is the hash of their words."""
    lengths = phrases.select("phrase", F.size("words").alias("length")).distinct()
    found = stage(search(documents, phrases).join(lengths, "phrase"), "candidates")
    here = F.slice("w", F.col("start") + 1, F.col("length"))
    same = F.md5(F.concat_ws(" ", here).cast("binary")) == F.col("phrase")
    return _with_words(documents, found).where(same).select("doc_id", "key", "phrase", "start", "length")


def blocks_of(benchmark: DataFrame, window: int) -> DataFrame:
    """(phrase, words, item_id): the windows of an item side by side, and its last one."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window + 1, F.lit(1))
    starts = F.explode(F.array_distinct(F.concat(F.sequence(F.lit(1), last, F.lit(window)), F.array(last)))).alias("s")
    cut = items.select("item_id", "w", starts).select("item_id", F.slice("w", F.col("s"), window).alias("words"))
    return cut.select(F.md5(F.concat_ws(" ", "words").cast("binary")).alias("phrase"), "words", "item_id").distinct()


def proximity_matches(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 3, percent: int = 80
) -> DataFrame:
    """(doc_id, key, item_id, n_places): items whose words stand near each other in a document, most places of a block found.

    A block of an item (`blocks_of`) matches at a start s of the document if for at least `percent` of its places i, rounded up,
    the i-th word stands at s + i or up to `slop` words off it: changed, lost, added and moved words do not matter. Of so
    few places that may fail, two more of the rarest are looked up in the index, terms that never occur included; at
    least two of them must stand together, within overlapping ranges of starts. Only these are compared with the text.

    Nulls, empty texts and empty tables have no matches. Repeated rows count once.
    """
    blocks = stage(blocks_of(benchmark, window), "blocks")
    terms = stage(blocks.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = stage(term_counts(documents, terms), "counts")
    size = F.size("words")
    need = F.ceil(size * percent / 100).cast("int")
    wanted = blocks.select("phrase", "words", need.alias("need"), F.least(size, size - need + 2).alias("lists")).distinct()
    places = wanted.select("phrase", F.posexplode("words").alias("shift", "term")).join(counts, "term", "left")
    places = places.groupBy("phrase").agg(F.sort_array(F.collect_list(
        F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "term", "shift")
    )).alias("places"))
    probes = wanted.join(places, "phrase").select(
        "phrase", (F.col("lists") - size + F.col("need")).alias("votes"), F.posexplode(F.slice("places", F.lit(1), F.col("lists"))).alias("rank", "p")
    ).where("p.seen > 0")
    probes = stage(probes.select("phrase", "votes", "rank", "p.term", "p.shift"), "probes")
    index = stage(postings(documents, stage(probes.select("term").distinct(), "probed")), "postings")
    width = 2 * slop + 1
    start = F.floor((F.col("pos") - F.col("shift")) / width)
    met = index.join(probes, "term").select("phrase", "votes", "doc_id", "key", "rank", F.explode(F.array(start, start + 1)).alias("range"))
    near = met.groupBy("phrase", "votes", "doc_id", "key", "range").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("rank"))).alias("ranks"))
    near = near.where(F.bit_count("ranks") >= F.col("votes")).select("phrase", "doc_id", "key", "range")
    found = stage(near.join(wanted.select("phrase", "words", "need"), "phrase"), "near")
    # Starts for which all places in reach lie in the range.
    low, high = (F.col("range") - 1) * width + slop, (F.col("range") + 1) * width - slop - 1

    def places_at(s: Column) -> Column:
        def stands(word: Column, i: Column) -> Column:
            first = F.greatest(s + i - slop, F.lit(0))
            return F.when(s + i + slop >= 0, F.array_contains(F.slice("w", first + 1, F.greatest(s + i + slop + 1 - first, F.lit(0))), word))

        return F.size(F.filter(F.transform("words", stands), lambda x: x))

    counted = F.array_max(F.transform(F.sequence(F.greatest(low, F.lit(0)).cast("int"), F.greatest(high, F.lit(0)).cast("int")), places_at))
    kept = _with_words(documents, found).select("doc_id", "key", "phrase", "need", counted.alias("n_places")).where("n_places >= need")
    named = kept.join(blocks.select("phrase", "item_id"), "phrase")
    return named.groupBy("doc_id", "key", "item_id").agg(F.max("n_places").alias("n_places"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, key, n_words, n_hit, items (sorted ids as strings), contaminated; one row per document row.

    A word is hit if it lies inside any occurrence of a phrase. Null and empty texts have no words and no hits; items
    without words are no phrases. An item without item_id hits words but is not listed. Repeated rows of either table
    change nothing else. Other columns are ignored. With an empty benchmark nothing is hit.
    """
    phrases = stage(phrases_of(benchmark, window), "phrases")
    matches = stage(phrase_matches(documents, phrases), "matches")
    inside = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")
    covered = matches.select("doc_id", "key", "start", "length").distinct().select("doc_id", "key", inside)
    hit = covered.distinct().groupBy("doc_id", "key").agg(F.count("*").alias("n_hit"))
    listed = matches.select("doc_id", "key", "phrase").distinct().join(phrases.select("phrase", "item_id"), "phrase")
    listed = listed.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    both = hit.join(listed.withColumnsRenamed({"doc_id": "_id", "key": "_key"}), _same("doc_id", "key", "_id", "_key"))
    both = both.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_hit", "items")
    counted = _keyed(documents).select("doc_id", "key", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    joined = counted.join(both, _same("doc_id", "key", "_id", "_key"), "left")
    hits = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id",
        "key",
        "n_words",
        hits.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (hits > 0).alias("contaminated"),
    )


def _same(id_a: str, key_a: str, id_b: str, key_b: str) -> Column:
    return F.col(id_a).eqNullSafe(F.col(id_b)) & (F.col(key_a) == F.col(key_b))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of `documents` without a benchmark phrase, as they are."""
    phrases = stage(phrases_of(benchmark, window), "phrases")
    hit_id, hit_key = fresh(documents, "hit_id", "hit_key")
    hit = phrase_matches(documents, phrases).select(F.col("doc_id").alias(hit_id), F.col("key").alias(hit_key)).distinct()
    hit = stage(hit, "contaminated")
    few = hit.count() <= BROADCAST_KEYS
    same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.xxhash64("text") == F.col(hit_key))
    return documents.join(F.broadcast(hit) if few else hit, same, "left_anti")
