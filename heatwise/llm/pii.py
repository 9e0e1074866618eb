"""Personal data by patterns, and information-theoretic sanitisation of what reveals it.

The values that the patterns find (e-mail addresses, IP addresses, card and phone
numbers) are the protected entities, and so are what several values share: the domain
of an address, the first three parts of an IP address, the first six digits of a card,
the digits of a phone number before the last seven.  The corpus says how strongly a
term reveals an entity c: with p taken over passages, a term t tells
PMI(c; t) = log p(c, t) / (p(c) p(t)) of the entity's information IC(c) = -log p(c).
A term whose share PMI / IC reaches the disclosure threshold, with enough documents to
say so, is generalised to the class of words with its first letters if that class
stays below the threshold, and removed otherwise.

Passages cover every text from end to end: blocks of ``2 * window`` words (runs without
white space, of at most 320 code points; longer runs are cut), each with the block after
it, so that every block lies in two passages and words up to ``2 * window`` apart always
share one, whatever stands between.  c, t and both are counted over the same passages.
A passage has a bounded number of words, so an entity with n occurrences gives O(n) rows.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwise.llm.common import broadcast_checked, keyed_documents, land, packed_rows

# The kinds in the order in which they are listed, and their patterns.  The
# look-behinds and possessive loops match what the plain patterns match, in linear time:
# a run that fails from its first letter fails from every later one.
BASE_KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM_KINDS = ("general", "removed")
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
_WORD = r"\p{L}{3,}+"
# words with the white space behind them; the pattern leaves nothing out
_BLOCK = r"(?:\S{1,320}+\s{0,320}+|\s{1,320}+){1,%d}+"
_PART_SIZE = 512
_ANY = ""  # stands in every passage: its counts are those of the entity, and of all passages


@dataclass(frozen=True)
class Disclosure:
    """When a term counts as revealing, and how it is generalised."""

    threshold: float = 0.9   # share of the entity's information that the term tells
    min_docs: int = 3        # documents that hold the term beside the entity
    window: int = 8          # half the words of a block
    stem: int = 3            # letters that a generalised term keeps


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Whether the digits of ``hit`` pass the Luhn check; every second one from the right is doubled."""
    digits = F.split(F.reverse(_digits(hit)), "")
    total = F.aggregate(
        F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(_IP)
    if kind == "card":
        return F.when(F.length(_digits(hit)).between(12, 19), _luhn(hit)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _pieces(kind: str) -> Column:
    """(kind, at, gap, hit) of every match: its number, the length of the text before it, and itself.

    ``split`` gives the texts between the matches that ``regexp_extract_all`` gives.
    """
    pattern = PATTERNS[kind]
    gaps = F.split(F.col("text"), pattern, -1)
    hits = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))
    return F.when(F.col("text").rlike(pattern), F.transform(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.length(x["gap"]).alias("gap"),
                              x["hit"].alias("hit")))).otherwise(F.array())


def entity_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end, hit) of the base findings of keyed documents."""
    pieces = rows.select("doc_id", "th", *[_pieces(k).alias(k) for k in BASE_KINDS])
    flat = pieces.select("doc_id", "th", F.explode(F.concat(*BASE_KINDS)).alias("p")).select("doc_id", "th", "p.*")
    # text before a match: all gaps and matches before it in the same document
    upto = Window.partitionBy("doc_id", "th", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.coalesce(F.length("hit"), F.lit(0))).over(upto)
    placed = flat.where("hit IS NOT NULL").dropDuplicates(["doc_id", "th", "kind", "at"]).withColumn("end", end)
    test = F.lit(False)
    for k in BASE_KINDS:
        test = F.when(F.col("kind") == k, _passes(k, F.col("hit"))).otherwise(test)
    return placed.where(test).select("doc_id", "th", "kind", (F.col("end") - F.length("hit")).alias("start"), "end",
                                     "hit")


def _entities() -> Column:
    """What a finding protects: its value, and what it shares with other values of its kind (if anything)."""
    kind, hit, digits = F.col("kind"), F.col("hit"), _digits(F.col("hit"))
    shared = (F.when(kind == "email", F.concat(F.lit("@"), F.lower(F.substring_index(hit, "@", -1))))
              .when(kind == "ip", F.concat(F.substring_index(hit, ".", 3), F.lit(".*")))
              .when(kind == "card", F.concat(F.left(digits, F.lit(6)), F.lit("*")))
              .when(F.length(digits) > 7, F.concat(F.left(digits, F.length(digits) - 7), F.lit("*"))))
    return F.transform(F.array_compact(F.array(hit, shared)), lambda e: F.concat_ws(":", kind, e))


def _class_of(term: Column, rule: Disclosure) -> Column:
    return F.concat(F.left(term, F.lit(rule.stem)), F.lit("*"))


def _blocks(rule: Disclosure) -> Column:
    return F.regexp_extract_all(F.col("text"), F.lit(_BLOCK % (2 * rule.window)), F.lit(0))


def _terms_in(block: Column, rule: Disclosure) -> Column:
    """The distinct words of a block, lower case, and their classes; addresses are no words (no other kind has letters)."""
    plain = F.regexp_replace(block, PATTERNS["email"], " ")
    words = F.array_distinct(F.transform(F.regexp_extract_all(plain, F.lit(_WORD), F.lit(0)), F.lower))
    return F.array_distinct(F.concat(words, F.transform(words, lambda w: _class_of(w, rule))))


def _both(a: Column, b: Column) -> Column:
    return F.array_distinct(F.concat(F.array(F.lit(_ANY)), a, b))


def _beside(rows: DataFrame, spans: DataFrame, rule: Disclosure) -> DataFrame:
    """(entity, word, n_ct, n_docs): the passages and the documents that hold both, for all words of those passages.

    Every row counts in ``n_ct``, as it does in the words' own counts; rows of one id and
    text are one document.
    """
    none = F.array().cast("array<string>")
    keys = broadcast_checked(land(spans.select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct(), "pii-holders"))
    here = (rows.join(keys, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi")
            .groupBy("doc_id", "th").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    blocks = here.select("doc_id", "th", "copies", F.posexplode(_blocks(rule)).alias("at", "block")).select(
        "doc_id", "th", "copies", "at", F.length("block").alias("size"), _terms_in(F.col("block"), rule).alias("words"))
    along = Window.partitionBy("doc_id", "th").orderBy("at")
    placed = blocks.select(
        "doc_id", "th", (F.sum("size").over(along) - F.col("size")).alias("start"), F.lit(0).alias("side"),
        F.struct("at", "copies", F.coalesce(F.lag("words").over(along), none).alias("before"), "words",
                 F.coalesce(F.lead("words").over(along), none).alias("after")).alias("near"))
    # a finding stands in the last block that starts at or before it
    upto = Window.partitionBy("doc_id", "th").orderBy("start", "side").rowsBetween(Window.unboundedPreceding, 0)
    found = spans.select("doc_id", "th", F.col("start").cast("long").alias("start"), F.lit(1).alias("side"), _entities().alias("entities"))
    marks = placed.unionByName(found, allowMissingColumns=True).withColumn("near", F.last("near", True).over(upto))
    passages = F.array(F.struct(F.col("near.at").alias("at"), _both(F.col("near.before"), F.col("near.words")).alias("words")),
                       F.struct((F.col("near.at") + 1).alias("at"), _both(F.col("near.words"), F.col("near.after")).alias("words")))
    met = (marks.where("side = 1").select("doc_id", "th", "near.copies", F.explode("entities").alias("entity"), passages.alias("passages"))
           .select("doc_id", "th", "copies", "entity", F.explode("passages").alias("p"))
           .select("doc_id", "th", "copies", "entity", "p.at", "p.words").dropDuplicates(["doc_id", "th", "entity", "at"]))
    return (met.select("doc_id", "th", "copies", "entity", F.explode("words").alias("word"))
            .groupBy("entity", "word", "doc_id", "th").agg(F.sum("copies").alias("n"))
            .groupBy("entity", "word").agg(F.sum("n").alias("n_ct"), F.count(F.lit(1)).alias("n_docs")))


def _passages_with(rows: DataFrame, wanted: DataFrame, rule: Disclosure) -> DataFrame:
    """(word, n_t): the passages of all texts that hold each wanted word; an empty text is one passage without words."""
    none = F.array(F.array().cast("array<string>"))
    texts = rows.select(F.transform(_blocks(rule), lambda b: _terms_in(b, rule)).alias("blocks"))
    words = texts.select(F.explode(F.zip_with(F.concat(none, "blocks"), F.concat("blocks", none), _both)).alias("words")).select(
        F.explode("words").alias("word"))
    return words.join(broadcast_checked(wanted), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n_t"))


def revealing_terms(rows: DataFrame, spans: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(term, kind) of the terms to generalise or remove, from the co-occurrences of the whole corpus.

    A term that reveals any entity is listed; it is generalised only if its class stays
    below the threshold for every entity beside which the term stands often enough.
    """
    asked = land(_beside(rows, spans, rule).where(F.col("n_docs") >= rule.min_docs), "pii-cooccurrence")
    n_word = land(_passages_with(rows, asked.select("word").distinct(), rule), "pii-words")
    n_all = F.coalesce(n_word.where(F.col("word") == _ANY).select("n_t").scalar().cast("double"), F.lit(0.0))
    n_entity = asked.where(F.col("word") == _ANY).select("entity", F.col("n_ct").alias("n_c"))
    told = asked.where(F.col("word") != _ANY).join(n_entity, "entity").join(n_word, "word").select(
        "entity", "word", ((F.log(n_all * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) >= rule.threshold * F.log(
            n_all / F.col("n_c"))) & (F.col("n_c") < n_all)).alias("told"))
    terms = told.where(~F.col("word").endswith("*")).withColumn("class", _class_of(F.col("word"), rule))
    classes = told.where(F.col("word").endswith("*")).select(F.col("word").alias("class"), "entity",
                                                             F.col("told").alias("class_told"))
    judged = terms.join(classes, ["entity", "class"], "left").groupBy("word").agg(
        F.max("told").alias("told"), F.max(F.coalesce("class_told", F.lit(False))).alias("class_told"))
    return judged.where("told").select(F.col("word").alias("term"),
                                       F.when(F.col("class_told"), "removed").otherwise("general").alias("kind"))


def term_spans(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end) of every occurrence of the given terms."""
    words = F.transform(F.regexp_extract_all(F.col("text"), F.lit(_WORD), F.lit(0)), lambda w: F.lower(w))
    listed = broadcast_checked(terms)
    holders = broadcast_checked(land(
        rows.select("doc_id", "th", F.explode(F.array_distinct(words)).alias("term"))
        .join(listed, "term", "left_semi").select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct(),
        "pii-term-documents"))
    here = rows.join(holders, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi")
    gaps, hits = F.split(F.col("text"), _WORD, -1), F.regexp_extract_all(F.col("text"), F.lit(_WORD), F.lit(0))
    flat = (here.select("doc_id", "th", F.posexplode(F.arrays_zip(F.transform(gaps, F.length).alias("gap"), hits.alias("hit")))
                        .alias("at", "x")).select("doc_id", "th", "at", "x.gap", "x.hit").where("hit IS NOT NULL")
            .dropDuplicates(["doc_id", "th", "at"]))
    end = F.sum(F.col("gap") + F.length("hit")).over(Window.partitionBy("doc_id", "th").orderBy("at"))
    return (flat.withColumn("end", end).withColumn("term", F.lower("hit")).join(listed, "term")
            .select("doc_id", "th", "kind", (F.col("end") - F.length("hit")).alias("start"), "end"))


def _joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    listed = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_pii(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, found) of every row: ``found`` holds (start, rank, end, kind) in order.

    Base kinds come from the patterns, ``general`` and ``removed`` are the terms that the
    corpus shows to reveal a base finding, where they don't touch one.  Null or empty
    text has no findings; repeated rows come out each and are one document among those
    that a term needs, so that a repeat adds no evidence; null ids stay null;
    other columns are left out.
    """
    rows = keyed_documents(docs, id_col, text_col)
    base = land(entity_spans(rows), "pii-entities")
    terms = land(revealing_terms(rows, base, rule), "pii-terms")
    told = term_spans(rows, terms)
    rank = F.array_position(F.array(*map(F.lit, BASE_KINDS + TERM_KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    both = base.select("doc_id", "th", span.alias("s")).unionByName(told.select("doc_id", "th", span.alias("s")))
    found = both.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("s")).alias("found"))
    # a term inside a base finding is part of it
    base_of = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    found = found.withColumn("base", base_of).withColumn("found", F.filter("found", lambda s: s["kind"].isin(
        *BASE_KINDS) | ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))).drop("base")
    found = found.withColumnsRenamed({"doc_id": "d", "th": "t"})
    return rows.select("doc_id", "th").join(
        found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left").select(
        "doc_id", "th", F.coalesce("found", F.array().cast(found.schema["found"].dataType)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("found"), BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("found"), BASE_KINDS + TERM_KINDS).alias("spans"))


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every finding replaced: its kind in brackets, or a generalised term's first letters and a star.

    Of findings that overlap, the one that starts first (then the first listed) is
    replaced.  Null text stays null; other columns are as they are.
    """
    found = find_pii(docs, rule, id_col, text_col).where(F.size("found") > 0).dropDuplicates(["doc_id", "th"])
    found = found.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "found")
    joined = packed_rows(docs, id_col, text_col).join(
        found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    # pieces are cut from parts of the text, since a place in a whole text is found by counting from its start
    joined = joined.withColumn("parts", F.when(F.col("found").isNotNull(), F.regexp_extract_all(
        F.col("doc").getField(text_col).cast("string"), F.lit("(?s).{1,%d}+" % _PART_SIZE), F.lit(0))))

    def cut(start, end):
        first = F.floor(start / _PART_SIZE).cast("int")
        held = F.slice("parts", first + 1, F.greatest(F.ceil(end / _PART_SIZE).cast("int") - first, F.lit(0)))
        return F.substr(F.array_join(held, ""), (start % _PART_SIZE).cast("int") + 1, (end - start).cast("int"))

    # the findings that are replaced, then the text between them and what stands for each, as one list
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    taken = F.aggregate("found", none, lambda acc, s: F.when(
        (F.size(acc) == 0) | (s["start"] >= F.element_at(acc, -1)["end"]),
        F.concat(acc, F.array(F.struct(s["kind"].alias("kind"), s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))))
    ).otherwise(acc))
    joined = joined.withColumn("taken", taken)

    def put(s, i):
        before = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("taken", i - 1)["end"])
        shown = F.when(s["kind"] == "general", F.concat(cut(s["start"], s["start"] + rule.stem), F.lit("*"))
                       ).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(cut(before, s["start"]), shown)

    rest = cut(F.element_at("taken", -1)["end"], F.size("parts").cast("long") * _PART_SIZE)
    clean = F.concat(F.array_join(F.transform("taken", put), ""), rest)
    return joined.select(*[F.when(F.col("found").isNull(), F.col("doc").getField(c)).otherwise(clean).alias(c) if c == text_col
                           else F.col("doc").getField(c).alias(c) for c in docs.columns])
