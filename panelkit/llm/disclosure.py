"""Personal data, and the words that give it away, in DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each value is a protected
entity. Words near an entity are candidates for disclosing it. Over the whole corpus, with N
documents of which n(e) hold the entity, n(t) the term and n(t, e) the term near the entity,

    disclosed share of t for e = log2(N n(t, e) / (n(t) n(e))) / log2(N / n(e)),

pointwise mutual information over the information content of the entity: 1 says that the term
occurs only near this entity. Terms from DISCLOSED on are generalised to a placeholder, terms
from REMOVED on are taken out, in all documents that hold the entity. Every pair is judged: if
fewer than MIN_TEXTS different texts show it, its share counts if the counts of the corpus leave
a chance of CHANCE at most that so many texts hold both by accident. An entity and a term that
stand in one text of a large corpus and nowhere else pass; in a corpus of less than e / CHANCE
(272) texts one text says nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.staging import fits_in_broadcast, settle

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
CONTEXT = 80
"""Characters on each side of an entity in which its terms are looked for."""
MIN_TEXTS = 3
CHANCE = 0.01
DISCLOSED, REMOVED = 0.8, 0.99
BROADCAST_BYTES = 16 << 20

# The contract's patterns with possessive repeats, which find the same and neither recurse nor
# start again inside a run of the same characters.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap test that every text with a match passes.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def _small_number(part: Column) -> Column:
    """A run of digits is at most 255, whatever its leading zeros."""
    plain = F.regexp_replace(part, r"^0+(?=.)", "")
    return F.when(F.length(plain) <= 3, plain.cast("int") <= 255).otherwise(False)


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - 1 - place, F.lit(1)).cast("int")
        twice = F.when(place % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    # place 0 is the digit before the last one; the last one is added as it is
    places = F.sequence(F.lit(0), F.length(digits) - 2)
    rest = F.aggregate(places, F.lit(0), add)
    return (rest + F.substring(digits, -1, 1).cast("int")) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small_number)
    digits = F.regexp_replace(value, "[^0-9]", "")
    low, high = (16, 19) if kind == "card" else (8, 15)
    sized = F.length(digits).between(low, high)
    return F.when(sized, _luhn(digits)).otherwise(False) if kind == "card" else sized


def _places(text: Column, found: Column, pattern: Column) -> Column:
    """(start, end, value) of all matches: what lies between them tells where they are."""
    between = F.split(text, pattern, -1)

    def step(state: Column, n: Column) -> Column:
        value = F.element_at(found, n)
        start = state["at"] + F.length(F.element_at(between, n))
        end = start + F.length(value)
        span = F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"), value.alias("value")
        )
        return F.struct(
            end.cast("long").alias("at"), F.concat(state["out"], F.array(span)).alias("out")
        )

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.expr("cast(array() as array<struct<start:long,end:long,value:string>>)").alias("out"),
    )
    folded = F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda s: s["out"])
    none = F.expr("cast(array() as array<struct<start:long,end:long,value:string>>)")
    return F.when(F.size(found) > 0, folded).otherwise(none)


def _checked(kind: str, places: Column) -> Column:
    """Places whose value passes the check of its kind, with the kind."""
    valid = F.filter(places, lambda s: _valid(kind, s["value"]))
    return F.transform(
        valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"])
    )


def _number_of(kind: str) -> Column:
    return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__spans``: kind, start, end and value of all base matches.

    Leftmost and non-overlapping per kind; offsets are code points, end exclusive; kinds in
    order, then starts. A match that fails its check is dropped and not tried again shorter.
    Matches are searched once per kind and only where the text holds a hint of the kind.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = {}
    for kind, pattern in PATTERNS.items():
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        hint = HINTS[kind]
        none = F.expr("cast(array() as array<string>)")
        found[f"__{kind}"] = F.when(text.contains(hint), matches).otherwise(none) if hint else matches
    docs = docs.withColumns(found)
    parts = []
    for kind, pattern in PATTERNS.items():
        parts.append(_checked(kind, _places(text, F.col(f"__{kind}"), F.lit(pattern))))
    docs = docs.withColumn("__spans", F.concat(*parts))
    return docs.drop(*found)


ANY_WORD = r"\p{L}\p{M}\p{N}"
"""What a term is made of: letters, their marks and digits."""


def _words(text: Column, short: bool) -> Column:
    """Distinct words in lower case: all with ``short``, else those of three letters and more."""
    if short:
        return F.array_distinct(F.array_remove(F.split(F.lower(text), f"[^{ANY_WORD}]++"), ""))
    words = F.split(F.lower(text), r"[^\p{L}]++")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))


def _entities(marked: DataFrame, short: bool) -> DataFrame:
    """(key, content, entity, term): words near each entity, with an empty term for the entity itself."""
    text = F.col("text").cast("string")
    spans = marked.where(F.size("__spans") > 0).select(
        _key().alias("key"), text.alias("text"), F.explode("__spans").alias("s")
    )
    begin = F.greatest(F.col("s.start") - CONTEXT, F.lit(0))
    before = F.substring(F.col("text"), (begin + 1).cast("int"), (F.col("s.start") - begin).cast("int"))
    after = F.substring(F.col("text"), (F.col("s.end") + 1).cast("int"), F.lit(CONTEXT))
    terms = F.concat(F.array(F.lit("")), _words(F.concat_ws(" ", before, after), short))
    return spans.select(
        "key",
        F.md5(F.col("text").cast("binary")).alias("content"),
        F.concat_ws(":", F.col("s.kind"), F.lower(F.col("s.value"))).alias("entity"),
        F.explode(F.array_distinct(terms)).alias("term"),
    )


def _key() -> Column:
    """Names a document by id and text."""
    return F.md5(
        F.concat_ws(
            "\u0001", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text")
        ).cast("binary")
    )


def _log_chance(total: int) -> Column:
    """Chernoff's bound for the chance that ``texts`` or more texts hold term and entity by accident.

    Copies of a text near the entity count once.
    """
    texts = F.col("texts")
    spread = F.greatest(F.col("n_term") - F.col("n"), F.lit(0)) + texts
    mean = spread * F.col("texts_entity") / F.lit(float(total))
    return F.when(mean < texts, texts - mean + texts * F.log(mean / texts)).otherwise(0.0)


def disclosing_terms(docs: DataFrame, marked: DataFrame, short: bool = False) -> DataFrame:
    """(entity, terms): the terms of each entity from DISCLOSED on, with their share.

    ``docs`` is the corpus, ``marked`` the same with its spans. Counts cover all documents and
    are combined per task before they are shuffled; the words of the corpus are only counted
    if they are candidates, where these are few enough to tell each task. With ``short``, as in
    all results of this module, words of one or two letters or with digits are terms as well.
    """
    near = _entities(marked, short).groupBy("entity", "term", "content", "key").agg(F.lit(1).alias("n"))
    pairs = near.groupBy("entity", "term", "content").agg(F.sum("n").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    pairs = settle(pairs)
    candidates = settle(pairs.where("term != ''").select("term").distinct())
    words = docs.select(F.explode(_words(F.col("text").cast("string"), short)).alias("term"))
    few = fits_in_broadcast(candidates, F.octet_length("term") + 32, BROADCAST_BYTES)
    if few:
        words = words.join(F.broadcast(candidates), "term", "left_semi")
    total = docs.count()
    # settled, so that the join below can split the pairs of a frequent term
    held = settle(words.groupBy("term").agg(F.count("*").alias("n_term")))
    if few:
        held = F.broadcast(held)
    entities = pairs.where("term = ''").select(
        "entity", F.col("n").alias("n_entity"), F.col("texts").alias("texts_entity")
    )
    judged = pairs.where("term != ''").join(entities, "entity").join(held, "term")
    together = F.least("n", "n_entity", "n_term")
    shown = F.log2(F.lit(float(total)) * together / (F.col("n_term") * F.col("n_entity")))
    content = F.log2(F.lit(float(total)) / F.col("n_entity"))
    judged = judged.withColumn("share", F.when(content > 0, shown / content))
    sure = (F.col("texts") >= MIN_TEXTS) | (_log_chance(total) <= math.log(CHANCE))
    return (
        judged.where((F.col("share") >= DISCLOSED) & sure)
        .groupBy("entity")
        .agg(F.sort_array(F.collect_set(F.struct("term", "share"))).alias("terms"))
    )


def _with_terms(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Documents that hold personal data, with ``__terms``: spans of words that disclose it."""
    private = marked.where(F.size("__spans") > 0).withColumn("__key", _key())
    terms = settle(disclosing_terms(docs, marked, short=True))
    entity = F.transform(
        "__spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))
    )
    held = private.select("__key", F.explode(F.array_distinct(entity)).alias("entity")).distinct()
    held = (
        held.join(terms, "entity")
        .select(F.col("__key").alias("__own"), F.explode("terms").alias("t"))
        .groupBy("__own")
        .agg(
            F.sort_array(F.collect_set("t.term")).alias("__words"),
            F.sort_array(
                F.collect_set(F.when(F.col("t.share") >= REMOVED, F.col("t.term")))
            ).alias("__removed"),
        )
    )
    private = private.join(held, private["__key"] == held["__own"], "left").drop("__key", "__own")
    pattern = F.concat(
        F.lit(f"(?iu)(?<![{ANY_WORD}])(?:"), F.array_join("__words", "|"), F.lit(f")(?![{ANY_WORD}])")
    )
    text = F.col("text").cast("string")
    found = F.when(
        F.col("__words").isNotNull(), F.regexp_extract_all(text, pattern, F.lit(0))
    ).otherwise(F.expr("cast(array() as array<string>)"))
    private = private.withColumn("__found", found)
    places = F.filter(
        _places(text, F.col("__found"), pattern),
        lambda t: ~F.exists(
            "__spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])
        ),
    )
    kind = lambda t: F.when(
        F.array_contains(F.coalesce("__removed", F.array().cast("array<string>")), F.lower(t["value"])),
        F.lit("removed"),
    ).otherwise(F.lit(TERM))
    spans = F.transform(
        places, lambda t: F.struct(kind(t).alias("kind"), t["start"], t["end"], t["value"])
    )
    return private.withColumn("__terms", spans).drop("__found", "__words", "__removed")


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per document.

    ``spans`` lists kind:start:end of all base matches and then of the words that disclose
    them, ``term`` (generalised) or ``removed``. A NULL or empty text has none. Repeated rows
    give repeated rows with the same spans, an empty table none. Spans of all documents are
    settled once; only those that hold any keep their text, and only they are joined.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    marked = with_spans(own)
    text = F.when(F.size("__spans") > 0, F.col("text")).alias("text")
    marked = settle(marked.select("doc_id", text, "__spans"))
    clean = marked.where(F.size("__spans") == 0).withColumn("__terms", F.col("__spans"))
    found = clean.unionByName(_with_terms(own, marked))
    return found.select(
        "doc_id",
        *[_number_of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(F.col("__spans")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("__spans", "__terms")).alias("spans"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets, and disclosing words too.

    ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]`` and ``[TERM]``; removed words leave nothing.
    Where spans overlap, the first one is replaced and the rest of the others goes with it.
    Clean documents, NULL and empty texts stay as they are; all rows and columns are kept.
    """
    marked = settle(with_spans(docs))
    clean = marked.where(F.size("__spans") == 0).select(docs.columns)
    private = _with_terms(docs, marked)
    text = F.col("text").cast("string")
    spans = F.array_sort(
        F.transform(
            F.concat("__spans", "__terms"), lambda s: F.struct(s["start"], s["end"], s["kind"])
        )
    )

    def step(state: Column, s: Column) -> Column:
        gap = (s["start"] - state["at"]).cast("int")
        kept = F.substring(text, (state["at"] + 1).cast("int"), gap)
        mark = F.when(s["kind"] == "removed", F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
        apart = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], kept, mark)).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(
        s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))
    )
    private = private.withColumn("text", F.aggregate(spans, start, step, rest))
    return clean.unionByName(private.select(docs.columns))
