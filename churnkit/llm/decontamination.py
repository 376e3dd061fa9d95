"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Texts become templates: numbers in digits or words, units after a number and
capitalised words are replaced by typed placeholders, case and punctuation go.  A
capitalised word is a name wherever it stands, at the beginning of a sentence or
text too, unless it is one of a fixed list of function words: so a word's type
does not depend on what surrounds it, and an item and its copy get the same types.
Windows of ``window`` template words of the documents are hash-joined with those
of the benchmark items; a window with names also with the names as words, so that
copies in other capitals or other white space match.  A window of an item is evidence only
if at least half of its words are literal (no placeholders) and two literal words stand
side by side: lists of names, numbers or prices are no evidence for each other.  Windows
with the same shift between document and item are one alignment, in which every item
value stands for one document value, the most frequent one.  A window counts if each
of its slots is unchanged or has that value; different item values may stand for
equal ones.  So a question with other numbers or names is caught, one inconsistent
slot drops only the windows that hold it, and text that only shares the template's
wording is not found.

An item is found in a document when the windows that count are at least
``coverage`` of the item's evidence, or ``enough`` windows (with the defaults 13
words in a row), whichever is less.  An item without evidence (fewer than ``shortest``
words, or too few literal ones) is found where it is a whole line of a document, case, white
space and punctuation aside.

Most texts are never turned into templates.  Every window that is evidence has an anchor: of its
runs of four adjacent literal words (else three, else two) the longest.  A document with a matching window has the
anchor's words side by side, whatever its values are, so the runs of adjacent words of all texts are joined with the
anchors first, and only documents with an anchor are canonicalised, once for all sizes.

The benchmark is the smaller side and Spark broadcasts its anchors and windows only below its
size threshold; beyond it both sides are shuffled by hash.

Defined cases: null texts and texts without words match nothing; an item with
fewer than ``window`` words but ``shortest`` or more has the whole item as its only
window; benchmark rows that repeat an item_id are one item each text;
rows with null ids keep them; documents that repeat are reported once for each
(doc_id, text); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import by_size, free_names, stored

# Unit words replaced after a number.
UNITS = ("%", "mm", "cm", "m", "km", "inch", "inches", "feet", "foot", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg",
         "gram", "grams", "kilogram", "kilograms", "ton", "tons", "lb", "lbs", "pound", "pounds", "oz", "ounce", "ounces", "ml",
         "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute",
         "minutes", "h", "hr", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "mph", "kmh",
         "percent", "degree", "degrees", "dollar", "dollars", "cent", "cents", "euro", "euros")
# Number words; a ten and a one after it are one number.
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ONES = "one two three four five six seven eight nine".split()
NUMBERS = [*TENS, *ONES, *("zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
                           "hundred thousand million billion dozen").split()]
# Words that are no names, capitalised or not.
NO_NAMES = ("a an the this that these those he she it its they them their we us our you your his her him i my me and or but nor so yet if "
            "when whenever while where wherever who whom whose which what why how that then than thus there here as at by for from in into "
            "of off on onto out over to up down under with without within about above after before below between during since until "
            "through against among around because although though unless whether not no yes all any both each every either neither "
            "some many much more most few fewer less least several other another such only also even just still now today later "
            "is are was were be been being am do does did done has have had can could should would shall must let given suppose find "
            "calculate determine solve explain consider assume choose write read answer question note however therefore hence finally "
            "first next last once again").split()


#: Between words: all but letters, marks, digits and the marks of placeholders.  The plain ranges come first: Java
#: looks up character properties only for what is outside them.
_BETWEEN = "[^%0-9A-Za-z<>=_\\x{AA}\\x{B5}\\x{BA}\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{24F}\\p{L}\\p{M}\\p{N}]+"
_UPPER = r"[A-Z[[^\x00-\x7F]&&\p{Lu}]]"


#: Between letters: the same without digits and marks.
_NO_LETTERS = _BETWEEN.replace("%0-9", "").replace("<>=_", "").replace("\\p{N}", "")


def _choice(words: list[str]) -> str:
    """A pattern of any of the words, grouped by first letter."""
    heads = sorted({w[0] for w in words})
    return "|".join(f"{h}(?:{'|'.join(sorted({w[1:] for w in words if w[0] == h}, reverse=True))})" for h in heads)


def _one_case(text: Column) -> Column:
    """Upper case first: lower case alone keeps apart what upper case makes equal (final sigma, sharp s).

    The empty string in between keeps Spark from simplifying the two to lower case alone.
    """
    return F.lower(F.concat(F.upper(text), F.lit("")))


def canonical(text: Column) -> Column:
    """Template words with their slot values, one space apart: word, <num=7>, <unit=km>, <name=anna>.

    Every pattern begins with the rare character it needs, so most texts are only scanned.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[<>=_]", " ")
    t = F.regexp_replace(t, r"[.,:/](?<=\p{N}.)(?=\p{N})", "_")
    t = F.regexp_replace(t, rf"{_UPPER}(?<![\p{{L}}\p{{M}}\p{{N}}].)\p{{L}}*", "<name=$0>")
    t = _one_case(F.regexp_replace(t, r"\p{N}[\p{N}_]*", " <num=$0> "))
    t = F.trim(F.regexp_replace(t, _BETWEEN, " "))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    t = F.regexp_replace(t, rf"<name=({_choice([*NO_NAMES, *NUMBERS])})>(?= )", "$1")
    t = F.regexp_replace(t, rf" (?:({'|'.join(TENS)}) ({'|'.join(ONES)})|({_choice(NUMBERS)}))(?= )", " <num=$1$2$3>")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    return F.trim(F.regexp_replace(t, rf"(<num=[^>]*>) (?:<name=)?({units})>?(?= )", "$1 <unit=$2>"))


def plain(valued: Column) -> Column:
    """A canonical text with its names as words."""
    return F.when(F.contains(valued, F.lit("<name=")), F.regexp_replace(valued, "<name=([^>]*)>", "$1")).otherwise(valued)


def template(valued: Column) -> Column:
    """The words of a canonical text without their values."""
    return F.split(F.when(F.contains(valued, F.lit("=")), F.regexp_replace(valued, "=[^<>]*>", ">")).otherwise(valued), " ")


def windows(df: DataFrame, size: int, *keep: str) -> DataFrame:
    """Rows (keep, pos, h) of the windows of ``size`` words of ``valued``: of the template, and where a window has names
    also with the names as words, which does not depend on capitals."""
    # Each word is hashed once; a window is the hash of its words' hashes.
    hashed = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    words = df.select(*keep, hashed(template(F.col("valued"))).alias("typed"), F.when(
        F.contains("valued", F.lit("<name=")), hashed(template(plain(F.col("valued"))))).alias("folded"))
    # Windows are cut after the explosion: there the expressions are compiled, in a lambda they are interpreted.
    # The outer form keeps Spark from counting the words in a filter of its own, which would make them twice.
    at = words.select(*keep, "typed", "folded", F.posexplode_outer("typed").alias("pos", "first"))
    at = at.where(F.col("pos") <= F.size("typed") - size).select(*keep, "pos", _run("typed", F.col("pos"), size).alias("h"), F.when(
        F.col("folded").isNotNull(), _run("folded", F.col("pos"), size)).alias("second"))
    both = F.explode(F.array("h", F.when(F.col("second") != F.col("h"), F.col("second"))))
    return at.select(*keep, "pos", both.alias("h")).where("h IS NOT NULL")


def slots(valued: Column, start: Column, size: Column) -> Column:
    """(place, value) of the placeholders among ``size`` words from ``start`` (0-based); a name's value is its word."""
    marked = F.transform(F.slice(F.split(valued, " "), start + 1, size), lambda w, k: F.struct(k.alias("k"), w.alias("w")))
    return F.transform(F.filter(marked, lambda x: F.startswith(x["w"], F.lit("<"))),
                       lambda x: F.struct(x["k"].alias("k"), plain(x["w"]).alias("w")))


def _same(names: list[str]) -> Column:
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return cond


def _marked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__{c}") if c in names else F.col(c) for c in df.columns])


def folded(text: Column) -> Column:
    """The text in one case, null as empty."""
    return _one_case(F.coalesce(text, F.lit("")))


def _run(words: str, at, n: int) -> Column:
    """Hash of ``n`` words of the array from ``at`` (0-based)."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(n)])


def _octets(words: str, at, n: int) -> Column:
    total = F.octet_length(F.get(words, at))
    for k in range(1, n):
        total = total + F.octet_length(F.get(words, at + k))
    return total


def evidence(items: DataFrame, size: int) -> DataFrame:
    """item_id, ikey, at, h, run, words, octets of the windows of ``size`` words that are evidence: run hashes the anchor's ``words`` words."""
    words = items.select("item_id", "ikey", F.explode(F.array(template(F.col("valued")), template(plain(F.col("valued"))))).alias("ws")).distinct()
    cut = words.where(F.size("ws") >= size).select("item_id", "ikey", F.transform("ws", lambda w: F.xxhash64(w)).alias("hs"), "ws",
                                                   F.explode(F.sequence(F.lit(1), F.size("ws") - size + 1)).alias("i"))
    cut = cut.select("item_id", "ikey", (F.col("i") - 1).alias("at"), F.xxhash64(F.slice("hs", F.col("i"), size)).alias("h"),
                     F.slice("ws", F.col("i"), size).alias("ws"))
    literal = lambda w: ~(F.startswith(w, F.lit("<")) | F.contains(w, F.lit("%")))
    none = F.lit(None).cast("struct<octets:int,run:bigint,words:int>")

    def best(n: int) -> Column:
        if size < n:
            return none
        starts = F.filter(F.sequence(F.lit(0), F.lit(size - n)), lambda i: F.forall(F.slice("ws", i + 1, n), literal))
        return F.array_max(F.transform(starts, lambda i: F.struct(_octets("ws", i, n).alias("octets"), _run("ws", i, n).alias("run"), F.lit(n).alias("words"))))
    cut = cut.withColumns({"literals": F.size(F.filter("ws", literal)), "best": F.coalesce(*[best(n) for n in RUNS])})
    return cut.where((2 * F.col("literals") >= size) & F.col("best").isNotNull()).select("item_id", "ikey", "at", "h", "best.*")


#: Words of an anchor, the most telling first.
RUNS = (4, 3, 2)


def with_anchors(spark: SparkSession, docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, tkey, valued of the documents in which the words of an anchor (run, words, octets) stand side by side."""
    least = {r["words"]: r["octets"] for r in anchors.groupBy("words").agg(F.min("octets").alias("octets")).collect()}  # a row per length
    if not least:
        return docs.select("doc_id", F.xxhash64("text").alias("tkey"), F.col("text").alias("valued")).where("false")
    words = docs.select("doc_id", "text", F.split(folded(F.col("text")), _NO_LETTERS).alias("ws"))
    # As in ``windows``: compiled expressions, words made once.
    at = words.select("doc_id", "text", "ws", F.posexplode_outer("ws").alias("pos", "w"))
    runs = F.array(*[F.when(_octets("ws", F.col("pos"), n) >= least[n], _run("ws", F.col("pos"), n)) for n in sorted(least)])
    held = (at.select("doc_id", "text", F.explode(runs).alias("run")).where("run IS NOT NULL")
            .join(by_size(stored(spark, anchors.select("run").distinct(), "decon-anchors")), "run", "left_semi")
            .select("doc_id", F.xxhash64("text").alias("tkey")).distinct())
    keys = ["doc_id", "tkey"]
    some = by_size(_marked(stored(spark, held, "decon-some"), keys))
    return (docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").join(some, _same(keys), "left_semi").dropDuplicates(keys)
            .select(*keys, canonical(F.col("text")).alias("valued")))


def whole_lines(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, tkey, item_id, ikey of the documents that have an item's text as a line, up to case, white space and punctuation."""
    bare = lambda c: F.trim(F.regexp_replace(folded(c), _BETWEEN.replace("<>=_", ""), " "))
    wanted = items.select("item_id", "ikey", bare(F.col("text")).alias("line")).where("line <> ''")
    lines = docs.select("doc_id", F.xxhash64("text").alias("tkey"), F.explode_outer(F.split(F.coalesce("text", F.lit("")), "[\n\r]+")).alias("line"))
    return lines.withColumn("line", bare(F.col("line"))).join(wanted, "line").select("doc_id", "tkey", "item_id", "ikey").distinct()


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, window: int = 8, shortest: int = 5,
                 coverage: float = 0.5, enough: int = 6) -> DataFrame:
    """doc_id, tkey (hash of the text), item_id, windows (the item's evidence), matched, slots, kind of every item found in a document."""
    items = (benchmark.select("item_id", "text", F.xxhash64("text").alias("ikey"), canonical(F.col("text")).alias("valued"))
             .where("valued <> ''").withColumn("n", F.size(F.split("valued", " "))).dropDuplicates(["item_id", "ikey"]))
    items = stored(spark, items, "decon-items")
    sizes = [window, *sorted(r["n"] for r in items.where((F.col("n") >= shortest) & (F.col("n") < window)).select("n").distinct().collect())]
    known = None
    for size in sizes:  # at most ``window`` sizes
        of = items.where(F.col("n") >= window) if size == window else items.where(F.col("n") == size)
        part = evidence(of, size).withColumn("size", F.lit(size))
        known = part if known is None else known.unionByName(part)
    known = stored(spark, known, "decon-windows")
    ids = ["item_id", "ikey"]
    total = known.groupBy(*ids).agg(F.count_distinct("at").alias("windows"))
    bare = items.join(_marked(total.select(*ids), ids), _same(ids), "left_anti")
    texts = stored(spark, with_anchors(spark, docs, known.select("run", "words", "octets")), "decon-texts")
    found = None
    for size in sizes:
        right = by_size(stored(spark, known.where(F.col("size") == size).select(*ids, "h", "at").distinct(), "decon-known"))
        hits = windows(texts, size, "doc_id", "tkey").join(right, "h").drop("h").withColumn("size", F.lit(size))
        found = hits if found is None else found.unionByName(hits)
    # The windows' slots are looked up for matches only, so the joined table stays narrow.
    found = found.distinct().join(_marked(items.select(*ids, F.col("valued").alias("whole")), ids), _same(ids)).select(
        "doc_id", "tkey", *ids, "pos", "at", "size", (F.col("pos") - F.col("at")).alias("shift"),
        slots(F.col("whole"), F.col("at"), F.col("size")).alias("asked"))
    found = stored(spark, found, "decon-hits")
    by = ["doc_id", "tkey", "item_id", "ikey", "shift"]
    if found.where(F.size("asked") > 0).limit(1).count():
        checked = found.where(F.size("asked") == 0).withColumns({"slots": F.lit(0), "changed": F.lit(None).cast("int")}).unionByName(
            _consistent(spark, texts, found, by))
    else:
        checked = found.withColumns({"slots": F.lit(0), "changed": F.lit(0)})
    per_item = checked.groupBy("doc_id", "tkey", *ids).agg(
        F.count_distinct("at").alias("matched"), F.coalesce(F.max("slots"), F.lit(0)).cast("long").alias("slots"),
        F.coalesce(F.min("changed"), F.lit(0)).alias("changed"))
    per_item = per_item.join(_marked(total, ids), _same(ids)).drop(*[f"__{c}" for c in ids])
    enough_ = F.col("matched") >= F.least(F.col("windows") * F.lit(coverage), F.lit(float(enough)))
    out = per_item.where(enough_).select("doc_id", "tkey", "item_id", "windows", "matched", "slots", F.when(
        F.col("changed") > 0, F.lit("reparameterised")).otherwise(F.lit("verbatim")).alias("kind"))
    if bare.limit(1).count():
        one = F.lit(1).cast("long")
        out = out.unionByName(whole_lines(docs, bare).select("doc_id", "tkey", "item_id", one.alias("windows"), one.alias("matched"),
                                                             F.lit(0).cast("long").alias("slots"), F.lit("verbatim").alias("kind")))
    return out


def _consistent(spark: SparkSession, texts: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """The windows with slots that count, with their alignment's (by) number of item values and of changed ones.

    A slot counts if it is unchanged or has the document value that stands most often for its item value in the
    alignment (the first place of the item decides ties).  ``texts`` has the canonical documents.
    """
    asked = found.where(F.size("asked") > 0)
    keys = ["doc_id", "tkey"]
    words = _marked(texts.select(*keys, F.split(plain(F.col("valued")), " ").alias("words")), keys)
    filled = stored(spark, asked.join(words, _same(keys)).select(*found.columns, F.transform("asked", lambda x: F.struct(
        (F.col("at") + x["k"]).alias("place"), x["w"].alias("a"), F.get("words", F.col("pos") + x["k"]).alias("b"))).alias("pairs")), "decon-slots")
    pairs = filled.select(*by, F.explode("pairs").alias("p")).select(*by, "p.place", "p.a", "p.b").distinct()
    times = pairs.groupBy(*by, "a", "b").agg(F.count(F.lit(1)).alias("c"), F.min("place").alias("place"))
    stands = times.groupBy(*by, "a").agg(F.max_by("b", F.struct("c", -F.col("place"))).alias("b"))
    one = stands.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("a", "b"))).alias("stands"), F.count(F.lit(1)).cast("int").alias("slots"),
                                  F.sum(F.when(F.col("a") != F.col("b"), 1).otherwise(0)).cast("int").alias("changed"))
    counts = F.forall("pairs", lambda p: (p["a"] == p["b"]) | (F.col("stands")[p["a"]] == p["b"]))
    return filled.join(_marked(one, by), _same(by)).where(counts).select(*found.columns, "slots", "changed")


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; a row is dropped for its own text only."""
    a, b = free_names(docs, 2)
    bad = stored(spark, contaminated(spark, docs, benchmark, **options).select(F.col("doc_id").alias(a), F.col("tkey").alias(b))
                 .distinct(), "decon-found")
    return docs.join(by_size(bad), F.col("doc_id").eqNullSafe(F.col(a)) & (F.xxhash64("text") == F.col(b)), "left_anti")
