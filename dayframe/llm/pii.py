"""Personal data: base detectors, and information-theoretic sanitisation around them.

Base detectors find e-mail addresses, IPv4 addresses, payment cards and phone numbers. Each value
found is an entity to protect. Other terms of a text that holds an entity can give it away as well:
the corpus says how strongly. With N distinct texts, D(e) of them holding the entity, D(t) the
term, and J(e, t) both, the chance that a text with the term holds the entity is judged by leaving
the text at hand out, with the pooled chance m of rare terms in its place:

    P(e | t) = (J - 1 + m) / D(t)

m is learnt for each kind of entity from the terms that exactly two texts hold: how often the
second one holds the entity too, where the first one does. Terms that the same texts hold count
once for it, so that a pair of similar texts is one observation; it starts at one of two. A term
seen once beside an entity seen once has the chance m, whatever the size of the corpus.

The term's disclosure of the entity is the point-wise mutual information as a share of the entity's
information: log2(P(e | t) * N / D(e)) / log2(N / D(e)). Terms with a share of ``share`` or more
are generalised (replaced by their kind) from P(e | t) = ``generalise_at`` on and removed from
``remove_at`` on. All counts are of distinct texts, so copies change nothing, and terms count
wherever they are in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, stored, text_or_empty

# A match starts where no earlier match of the same kind could have begun: behind a character
# that cannot belong to it, or right behind the match before (\G). Possessive quantifiers keep
# failing attempts linear on long runs; neither changes what is found.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone")
MASK = "\x01"  # stands for the characters of base spans where terms are read
BASE_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn checksum of a string of digits is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                 d.cast("int") + 1)).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | (
            (F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(
            F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans(kind: str, text: Column, pattern: str, present: Column) -> Column:
    """All valid matches of one kind as structs in order.

    The text between matches and the matches alternate, so the running sum of their lengths gives
    every match's place in code points. Texts without a character that the kind needs are skipped.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern)
    state = F.struct(F.lit(0).alias("at"), F.array().cast(BASE_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        x["hit"].alias("value"))
        return F.struct(end.alias("at"), F.when(_valid(kind, x["hit"]), F.array_append(
            acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda h, g: F.struct(
        h.alias("hit"), g.alias("gap")))
    spans = F.aggregate(pairs, state, step, lambda acc: acc["spans"])
    return F.when(present, spans).otherwise(F.array().cast(BASE_SPAN))


def base_spans(text: Column) -> Column:
    """The base detectors' spans of a text (kind, start, end, value), ordered by start, then kind
    as listed in KINDS. Code points; ``end`` is exclusive."""
    digit = text.rlike("[0-9]")
    every = F.concat(
        _spans("email", text, EMAIL, F.contains(text, F.lit("@"))),
        _spans("ip", text, IP, digit & text.rlike(r"[0-9]\.[0-9]")),
        _spans("card", text, CARD, digit & text.rlike(r"[0-9][\x20-]?[0-9]")),
        _spans("phone", text, PHONE, F.contains(text, F.lit("+"))))
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    return F.transform(F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s.alias("span")))), lambda s: s["span"])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _entity(s: Column) -> Column:
    """What identifies the value of a span: addresses in lower case, numbers by their digits."""
    return F.concat_ws(":", s["kind"], F.when(s["kind"].isin("card", "phone"), _digits(s["value"]))
                       .otherwise(F.lower(s["value"])))


def normalised(word: Column) -> Column:
    """A word in lower case without surrounding characters that are neither letter nor digit."""
    return F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def _is_term(term: Column) -> Column:
    return (F.length(term) >= 3) & term.rlike(r"\p{L}")


def masked(text: Column, base: Column) -> Column:
    """The text with ``MASK`` for every character of a base span but white space: words stay where
    they are, and those that a span touches can be told."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = F.greatest(acc["at"], s["start"])
        gap = F.substring(text, acc["at"] + 1, start - acc["at"])
        hit = F.regexp_replace(F.substring(text, start + 1, F.greatest(s["end"] - start, F.lit(0))),
                               r"[^\x20\x09-\x0D]", MASK)
        return F.struct(F.greatest(start, s["end"]).alias("at"),
                        F.concat(acc["out"], F.array(gap, hit)).alias("out"))

    return F.aggregate(base, state, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def word_places(texts: DataFrame) -> DataFrame:
    """Every term of the texts (thash, __text: ``masked``) with its place: thash, term, start, end in
    code points. Words with ``MASK`` are no terms. One row a word; no array grows with the text."""
    words = texts.select("thash", F.posexplode(F.split(
        "__text", r"(?=[\x20\x09-\x0D])|(?<=[\x20\x09-\x0D])")).alias("pos", "word"))
    before = Window.partitionBy("thash").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("word")).over(before), F.lit(0)).cast("int")
    return words.select("thash", "word", normalised(F.col("word")).alias("term"), start.alias(
        "start"), F.length("word").alias("__n")).where(
        _is_term(F.col("term")) & ~F.contains("word", F.lit(MASK))).select(
        "thash", "term", "start", (F.col("start") + F.col("__n")).alias("end"))


def holders(rows: DataFrame, key: str, count: str, mark: str) -> DataFrame:
    """How many texts hold each ``key`` (rows are distinct), and a mark of which texts they are:
    keys with equal count and mark are held by the same texts."""
    return rows.groupBy(key).agg(F.count("*").alias(count), F.bit_xor(F.xxhash64("thash")).alias(mark))


def text_terms(docs: DataFrame) -> DataFrame:
    """(thash, term) of every distinct text and distinct term in it."""
    text = text_or_empty()
    texts = docs.select(F.xxhash64(text).alias("thash"), text.alias("__text")).dropDuplicates(["thash"])
    return texts.select("thash", F.explode(F.array_distinct(F.transform(
        F.split("__text", r"[\x20\x09-\x0D]+"), normalised))).alias("term")).where(
        _is_term(F.col("term")))


def find(docs: DataFrame, share: float = 0.6, generalise_at: float = 0.5,
         remove_at: float = 0.9) -> DataFrame:
    """The spans of every document.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. Row by row
    returns doc_id, thash (64-bit hash of the text), base (the detectors' spans) and terms (spans
    of disclosing terms: kind ``removed`` or ``generalised``), both ordered by start. NULL text is
    empty and has none. Rows with equal doc_id and text get equal spans; NULL doc_id is an
    ordinary value. An empty table gives an empty result.
    """
    text = text_or_empty()
    first = docs.select("doc_id", text.alias("__text"), F.xxhash64(text).alias("thash"))
    found = stored(first.withColumn("base", base_spans(F.col("__text"))).select(
        "doc_id", "thash", "base", F.when(F.size("base") > 0, masked(F.col("__text"), F.col("base")))
        .alias("__text")), "pii-base")
    copies = stored(found.groupBy("thash").agg(F.count("*").alias("__n")), "pii-copies")
    n_texts = copies.count()
    holding = stored(found.where(F.size("base") > 0).drop("doc_id").dropDuplicates(["thash"]),
                     "pii-texts")
    owned = holding.select("thash", F.explode(F.array_distinct(F.transform("base", _entity)))
                           .alias("entity"))
    # entities that the same texts hold have the same counts with every term: one stands for all
    entities = stored(owned.join(holders(owned, "entity", "de", "e"), "entity").select(
        "thash", "de", "e", F.substring_index("entity", ":", 1).alias("about")).distinct(),
        "pii-entities")
    # texts are spread before they become words, which then need no shuffle to be numbered
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = stored(word_places(holding.repartition(n_parts, "thash")), "pii-words")
    counts = stored(holders(text_terms(docs), "term", "dt", "t"), "pii-term-counts")
    terms = stored(join_groups(places.select("thash", "term").distinct(), counts, "term", "dt"),
                   "pii-terms")

    # no pair is held by more texts than its entity: the others cannot get there. Terms that the
    # same texts hold are one here, so a text gives a pair for each two different sets of texts
    pairs = stored(terms.select("thash", "dt", "t").distinct().join(entities, "thash").where(
        (F.least("de", "dt") >= generalise_at * F.col("dt")) | (F.col("dt") == 2)), "pii-pairs")
    pair = ["de", "e", "about", "dt", "t"]
    joint = stored(pairs.groupBy(*pair).agg(F.count("*").alias("joint")), "pii-joint")
    pool = joint.where("dt = 2").groupBy("about").agg(
        F.sum(F.col("joint") * (F.col("joint") - 1)).alias("again"), F.sum("joint").alias("first"))
    pooled = (F.coalesce("again", F.lit(0)) + 1) / (F.coalesce("first", F.lit(0)) + 2)
    own = F.log2(n_texts / F.col("de"))
    told_share = F.when(own > 0, F.log2(F.col("chance") * n_texts / F.col("de")) / own)
    telling = (joint.join(F.broadcast(pool), "about", "left")  # one row a kind
               .withColumn("chance", (F.col("joint") - 1 + pooled) / F.col("dt"))
               .where((F.col("chance") >= generalise_at) & (told_share >= share))
               .select(*pair, F.when(F.col("chance") >= remove_at, "removed")
                       .otherwise("generalised").alias("kind")))
    told = (pairs.join(telling, pair).groupBy("thash", "dt", "t")
            .agg(F.max("kind").alias("kind")).join(terms, ["thash", "dt", "t"]))
    spans = places.join(told.select("thash", "term", "kind"), ["thash", "term"]).groupBy("thash").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("__terms"))
    spans = spans.select("thash", F.transform("__terms", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.lit("").alias("value"))).alias("__spans"))
    by_text = stored(copies.join(spans, "thash", "left"), "pii-spans")
    return join_groups(found.drop("__text"), by_text, "thash", "__n").select(
        "doc_id", "thash", "base", F.coalesce("__spans", F.array().cast(BASE_SPAN)).alias("terms"))


def sanitise(text: Column, base: Column, terms: Column) -> Column:
    """The text with base spans replaced by their kind in angle brackets, generalised terms by
    ``<TERM>``, and removed terms cut out. A span that overlaps an earlier one is absorbed by it."""
    every = F.array_sort(F.transform(F.concat(base, terms), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mark = (F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", "<TERM>")
                .otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], -s["back"]).alias("at"), F.when(
            fresh, F.concat(acc["out"], F.array(gap, mark))).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(
            text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(every) == 0, text).otherwise(F.aggregate(every, state, step, finish))


def clean(docs: DataFrame, **options) -> DataFrame:
    """The documents with all their columns and sanitised texts; n_chars, if there, follows the
    text where it changed. Texts without personal data stay as they are, NULL included."""
    found = find(docs, **options)
    terms = stored(found.where(F.size("terms") > 0).select(
        F.col("doc_id").alias("__id"), F.col("thash").alias("__thash"), F.col("terms").alias(
            "__terms")).dropDuplicates(["__id", "__thash"]), "pii-terms")
    text = text_or_empty()
    rows = docs.withColumn("__hash", F.xxhash64(text)).withColumn("__base", base_spans(text))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__thash"))
    none = F.array().cast(BASE_SPAN)
    rows = rows.join(terms, on, "left").withColumn("__terms", F.coalesce("__terms", none))
    changed = (F.size("__base") > 0) | (F.size("__terms") > 0)
    rows = rows.withColumn("__text", F.when(changed, sanitise(
        F.col("text"), F.col("__base"), F.col("__terms"))).otherwise(F.col("text")))
    rows = rows.withColumn("__changed", changed)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("__text").alias(name)
        if name == "n_chars":
            return F.when(F.col("__changed"), F.length("__text")).otherwise(F.col(name)).cast(
                docs.schema[name].dataType).alias(name)
        return F.col(name)

    return rows.select(*[column(c) for c in docs.columns])
