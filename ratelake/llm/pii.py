"""Personal data: fixed patterns, and contextual patterns bootstrapped from them.

Base spans come from fixed patterns with checks (Luhn, number of digits, byte
range). They seed a bootstrap in the manner of Brin (1998) and Agichtein and
Gravano (2000): the words around seed entities become lexical patterns; the
graph of patterns and instances is scored in rounds, patterns by how many of
their instances are trusted, instances by the patterns they occur in; the
patterns that stay reliable then mark identifiers no fixed pattern knows.
Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import materialize, text_key

KINDS = ("email", "ip", "card", "phone")
# The four patterns. Possessive quantifiers and the look-behinds
# change no match (what follows a run can't match inside it); they keep the
# matcher linear and off the stack on very long runs. \G lets a match begin
# where the one before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A candidate identifier: neighbouring tokens on one line that hold a digit or '@'.
TOKEN = r"[^\s0-9@]*+[0-9@]\S*+"
CANDIDATE = rf"(?<!\S){TOKEN}(?:\x20{TOKEN})*+"
CONTEXT = 48


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of up to 19 digits (leading zeros add nothing)."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(1, 20):
        digit = F.substring(padded, i, 1)
        if i % 2 == 0:  # second, fourth ... from the right
            digit = F.translate(digit, "0123456789", "0246813579")
        total = total + digit.try_cast("int")
    return total % 10 == 0


def accepted(kind: str, m: Column) -> Column:
    """Whether a match of the kind's pattern is a base span."""
    if kind == "email":
        return m.isNotNull()
    if kind == "ip":
        part = lambda p: F.coalesce(F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.ltrim(p, F.lit("0"))), F.lit("999"))
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
    digits = _digits(m)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.coalesce(luhn(digits), F.lit(False))
    return F.length(digits).between(8, 15)


def matches(docs: DataFrame, pattern: str, needs: str | None = None) -> DataFrame:
    """Every match in whole texts, one row a key: key, start, end, m, gap (text before it), rest.

    The pattern's matches and the stretches between them come from the same
    scan rules, so a running sum of their lengths (code points) gives the
    places. ``rest`` is the stretch after the match, up to ``CONTEXT``.
    """
    some = docs.where(F.col("text").contains(needs)) if needs else docs
    found = some.select("key", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("ms"), "text").where(F.size("ms") > 0)
    found = found.withColumn("gaps", F.split("text", pattern, -1))
    pieces = F.transform(
        "ms",
        lambda m, i: F.struct(
            m.alias("m"),
            F.length(F.get("gaps", i)).alias("g"),
            F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("gap"),
            F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("rest"),
        ),
    )
    rows = found.select("key", F.posexplode(pieces).alias("i", "x"))
    to_here = Window.partitionBy("key").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("x.g") + F.length("x.m")).over(to_here)
    placed = rows.select("key", "i", "x.m", "x.gap", "x.rest", end.alias("end"))
    return placed.withColumn("start", F.col("end") - F.length("m"))


def base_spans(docs: DataFrame) -> DataFrame:
    """key, kind, start, end (code points, end exclusive), m (the text) of the fixed patterns."""
    parts = []
    for kind in KINDS:
        found = matches(docs, PATTERNS[kind], NEEDS[kind]).where(accepted(kind, F.col("m")))
        parts.append(found.select("key", F.lit(kind).alias("kind"), F.col("start").cast("long"), F.col("end").cast("long"), "m"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def fits(kind: Column, instance: Column, min_digits: int) -> Column:
    """Whether an unknown identifier has the form of a kind: something@something;
    two separators of an address; so many digits of a phone or card."""
    digits = F.length(_digits(instance))
    separators = F.length(F.regexp_replace(instance, "[^.:]", ""))
    email = instance.rlike(r"[^\s@]@[^\s@]")
    return F.when(kind == "email", email).when(kind == "ip", (separators >= 2) & (digits > 0)).otherwise((digits >= min_digits) & ~email)


def _islands(base: DataFrame) -> DataFrame:
    """key, start, end, kind, m of the stretches that base spans cover; of spans that overlap, the first kind's."""
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    spans = base.withColumn("fresh", fresh.cast("int"))
    to_here = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("island", F.sum("fresh").over(to_here))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    best = F.min(F.struct(order.alias("o"), "start", "kind", "m")).alias("best")
    found = spans.groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), best)
    return found.select("key", "start", "end", "best.kind", "best.m")


def _pieces(docs: DataFrame, base: DataFrame) -> DataFrame:
    """The runs of ``CANDIDATE`` cut at the base spans, in order: key, i (run), j, start, m,
    kind (of a base span, else null), cut (next to a base span in the run: after, before), gap, rest."""
    runs = matches(docs, CANDIDATE)
    run = F.struct(F.col("i"), F.col("m"), F.col("gap"), F.col("rest"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    spans = _islands(base)
    span = F.struct("start", "end", "kind", "m")
    both = runs.select("key", F.col("start").cast("long").alias("start"), F.lit(0).alias("o"), run.alias("run"), F.lit(None).cast("struct<start:long,end:long,kind:string,m:string>").alias("span"))
    both = both.unionByName(spans.select("key", "start", F.lit(1).alias("o"), span.alias("span")), allowMissingColumns=True)
    by = Window.partitionBy("key").orderBy("start", "o")
    # every base span starts in a run; one with lone marks inside may reach into the next
    both = both.withColumn("at", F.last("run.i", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    both = both.withColumn("covered", F.max("span.end").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    both = both.groupBy("key", "at").agg(
        F.first("run", ignorenulls=True).alias("run"),
        F.max(F.when(F.col("o") == 0, F.col("covered"))).alias("covered"),
        F.array_sort(F.collect_list("span")).alias("spans"),
    )
    first = F.greatest("run.start", F.coalesce("covered", F.lit(0)))
    both = both.withColumn("first", first).withColumn("chars", F.when((F.size("spans") > 0) | (first > F.col("run.start")), F.split("run.m", "")))
    none = F.lit(None).cast("string")

    def stretch(lo, hi, after, before):
        # a slice of single characters: linear in the run, however many spans cut it
        cut = F.array_join(F.slice("chars", (lo - F.col("run.start") + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int")), "")
        whole = F.when(F.size("chars") > 0, cut).otherwise(F.col("run.m"))
        return F.struct(lo.alias("start"), F.when(hi > lo, whole).otherwise("").alias("m"), none.alias("kind"), after.alias("after"), before.alias("before"))

    def cut_off(x, n):
        lo = F.when(n == 0, F.col("first")).otherwise(F.get("spans", n - 1)["end"])
        own = F.struct(x["start"].alias("start"), x["m"].alias("m"), x["kind"].alias("kind"), F.lit(True).alias("after"), F.lit(True).alias("before"))
        return F.array(stretch(lo, x["start"], (n > 0) | (lo > F.col("run.start")), F.lit(True)), own)

    last = F.coalesce(F.get("spans", F.size("spans") - 1)["end"], F.col("first"))
    tail = stretch(last, F.col("run.end"), last > F.col("run.start"), F.lit(False))
    parts = F.filter(F.concat(F.flatten(F.transform("spans", cut_off)), F.array(tail)), lambda x: x["m"] != "")
    both = both.select("key", "at", "run.gap", "run.rest", F.posexplode(parts).alias("j", "x"))
    return both.select("key", F.col("at").alias("i"), "j", "x.*", "gap", "rest")


#: Partial tokens and marks between a base span and an identifier beside it.
AFTER_SPAN = r"^(?:[^\s0-9@]*+\s++)?+(?:[\s(\[\"'<.,;!?)\]>|]|:(?!:))*+"
MARKS = r"\s.,;:!?)\]\"'>(\[<|"
BEFORE_SPAN = rf"(?:\s++[^\s0-9@]*+|(?<![{MARKS}])[{MARKS}]++)$"


def candidates(docs: DataFrame, base: DataFrame) -> DataFrame:
    """key, start, end, instance, kind (null: none known), patterns of every candidate.

    Runs of tokens are cut at the base spans: these are instances of their own,
    what stands before and after them in the run are further candidates.
    Patterns are lexical: the two words before, and the word before with the
    word after, in lower case with digits as '0'; a base span's kind stands for
    it as a word. Context reaches back over earlier candidates if there is
    nothing between.
    """
    found = _pieces(docs, base)
    shown = F.when(F.col("kind").isNotNull(), F.concat(F.lit(" <"), F.col("kind"), F.lit("> "))).otherwise(F.col("m"))
    gap = F.when(F.col("j") == 0, F.col("gap")).otherwise("")
    found = found.withColumn("gap", gap).withColumn("back", F.concat("gap", F.right(shown, F.lit(CONTEXT)))).withColumn("ahead", F.left(shown, F.lit(CONTEXT)))
    by_key, by_run = Window.partitionBy("key").orderBy("i", "j"), Window.partitionBy("key", "i").orderBy("j")
    none = F.lit("")
    before = F.concat(*[F.coalesce(F.lag("back", n).over(by_key), none) for n in (3, 2, 1)], "gap")
    after = F.concat(*[F.coalesce(F.lead("ahead", n).over(by_run), none) for n in (1, 2)], F.when(F.lead("ahead", 3).over(by_run).isNull(), F.col("rest")).otherwise(""))
    found = found.withColumn("left", F.right(before, F.lit(CONTEXT))).withColumn("right", F.left(after, F.lit(CONTEXT)))
    norm = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    found = found.withColumn("lefts", F.filter(F.split(norm("left"), r"\s+"), lambda w: w != ""))
    found = found.withColumn("rights", F.filter(F.split(norm("right"), r"\s+"), lambda w: w != ""))
    last = F.element_at("lefts", -1)
    pattern1 = F.when(F.size("lefts") >= 2, F.concat_ws(" ", F.lit("L"), F.get("lefts", F.size("lefts") - 2), last))
    pattern2 = F.when((F.size("lefts") >= 1) & (F.size("rights") >= 1), F.concat_ws(" ", F.lit("B"), last, F.lit("_"), F.get("rights", F.lit(0))))
    # sentence marks around an identifier are not part of it
    unknown = F.col("kind").isNull()
    skip = F.when(unknown & F.col("after"), F.length(F.regexp_extract("m", AFTER_SPAN, 0))).otherwise(0)
    found = found.withColumn("skip", skip).withColumn("m", F.when(F.col("skip") > 0, F.regexp_replace("m", AFTER_SPAN, "")).otherwise(F.col("m")))
    trimmed = F.regexp_replace(F.regexp_replace("m", BEFORE_SPAN, ""), BEFORE_SPAN, "")
    found = found.withColumn("m", F.when(unknown & F.col("before"), trimmed).otherwise(F.col("m")))
    lead = F.when(unknown, F.length(F.regexp_extract("m", r"^[(\[\"'<]*", 0))).otherwise(0)
    core = F.regexp_replace(F.regexp_replace("m", r"^[(\[\"'<]+", ""), r"[.,;:!?)\]\"'>]+$", "")
    found = found.withColumn("instance", F.when(unknown, core).otherwise(F.col("m")))
    found = found.where((F.length("instance") > 0) & (F.col("kind").isNotNull() | F.col("instance").rlike("[0-9@]")))
    start = F.col("start") + F.col("skip") + lead
    return found.select(
        "key", start.cast("long").alias("start"), (start + F.length("instance")).cast("long").alias("end"), F.lower("instance").alias("instance"),
        "kind", F.array_compact(F.array(pattern1, pattern2)).alias("patterns"),
    )


def score_patterns(edges: DataFrame, seeds: DataFrame, rounds: int, smoothing: float) -> DataFrame:
    """Reliable patterns by rounds over the graph: pattern, kind, score, support.

    ``edges``: pattern, instance, n; ``seeds``: instance, kind (trust 1). A
    pattern's score for a kind is its trusted share, smoothed; an instance that
    is no seed is trusted as much as its edges' patterns on average. Both steps
    are equi-joins followed by partial aggregation.
    """
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("all"))
    trust = seeds.withColumn("trust", F.lit(1.0))
    for i in range(rounds):
        on = edges.join(trust, "instance")
        seed_edge = F.when(F.col("trust") == 1, 1).otherwise(0)
        scored = on.groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("trust")).alias("good"), F.sum(seed_edge).alias("support"))
        scored = scored.join(totals, "pattern")
        scored = scored.select("pattern", "kind", (F.col("good") / (F.col("all") + smoothing)).alias("score"), "support")
        scored = materialize(scored, "pattern-scores")
        if i + 1 < rounds:
            degree = edges.groupBy("instance").agg(F.sum("n").alias("deg"))
            spread = edges.join(scored, "pattern").groupBy("instance", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("t"))
            spread = spread.join(degree, "instance").select("instance", "kind", F.least(F.col("t") / F.col("deg"), F.lit(0.99)).alias("trust"))
            spread = spread.join(seeds.select("instance").distinct(), "instance", "left_anti")
            trust = materialize(seeds.withColumn("trust", F.lit(1.0)).unionByName(spread), "instance-trust")
    return scored


def find(
    docs: DataFrame,
    rounds: int = 3,
    min_score: float = 0.6,
    min_support: int = 4,
    smoothing: float = 2.0,
    min_digits: int = 5,
) -> DataFrame:
    """Spans of ``docs`` (key, text; null texts have none): key, kind, start, end, base.

    Base spans all stay. A bootstrapped span (base false) is a candidate beside
    or apart from the base spans, in the context of a pattern with a score of
    ``min_score`` for a kind, met with ``min_support`` different seeds; it has
    the form of that kind (``fits``) or at least ``min_digits`` digits; it
    doesn't overlap a base span. The best-scored pattern gives its kind, first
    among the kinds whose form it has. Keys must stand for texts: rows with one
    key have one text.
    """
    # a text is scanned once; copies go in the partial aggregation before the shuffle
    docs = materialize(docs.where(F.col("text").isNotNull()).dropDuplicates(["key"]), "texts")
    base = materialize(base_spans(docs), "base-spans")
    cand = materialize(candidates(docs, base), "candidates")
    by_pattern = cand.select("key", "start", "end", "instance", "kind", F.explode("patterns").alias("pattern"))
    edges = materialize(by_pattern.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n")), "pattern-graph")
    seeds = cand.where(F.col("kind").isNotNull()).groupBy("instance").agg(F.min("kind").alias("kind"))
    seeds = materialize(seeds, "seeds")
    good = score_patterns(edges, seeds, rounds, smoothing).where((F.col("score") >= min_score) & (F.col("support") >= min_support))
    unseen = by_pattern.where(F.col("kind").isNull()).drop("kind").join(good, "pattern")
    unseen = unseen.withColumn("fits", fits(F.col("kind"), F.col("instance"), min_digits))
    unseen = unseen.where(F.col("fits") | (F.length(_digits(F.col("instance"))) >= min_digits))
    found = unseen.groupBy("key", "start", "end").agg(F.max(F.struct("fits", "score", "kind")).alias("best"))
    found = found.select("key", F.col("best.kind").alias("kind"), "start", "end")
    taken = base.select("key", F.col("start").alias("s"), F.col("end").alias("e")).join(found.select("key").distinct(), "key", "left_semi")
    crossing = (found["key"] == taken["key"]) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))
    found = found.join(taken, crossing, "left_anti")
    return base.drop("m").withColumn("base", F.lit(True)).unionByName(found.withColumn("base", F.lit(False)))


def _joined(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_<kind> of the base spans, base_sha256, spans (base and bootstrapped) of every row.

    Null text: as empty, no spans. Null and repeated ids have a row each; equal
    texts share their spans. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", text_key("text"))
    spans = find(docs.select("key", "text"), **options)
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    item = F.struct(F.element_at(order, F.col("kind")).alias("o"), "start", "end", "kind")
    counts = [F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in KINDS]
    per_text = spans.groupBy("key").agg(
        *counts,
        F.collect_list(F.when(F.col("base"), item)).alias("own"),
        F.collect_list(item).alias("every"),
    )
    per_text = per_text.select("key", *[f"n_{k}" for k in KINDS], _joined(F.col("own")).alias("own"), _joined(F.col("every")).alias("spans"))
    out = docs.select("doc_id", "key").join(materialize(per_text, "text-spans"), "key", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("own", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
