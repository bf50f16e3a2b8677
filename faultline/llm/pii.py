"""Personal data: four exact kinds, and identifiers found by bootstrapped contexts. DataFrame functions only.

Seeds (the exact kinds) induce lexical patterns, the words around an entity. Patterns and instances form a graph
that Spark scores in rounds: a pattern is as sure as the instances it meets, an instance as sure as its patterns.
Instances that no exact kind covers, but sure patterns surround, are added.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.lineage import cut_lineage
from faultline.llm.common import fresh, text_key

KINDS = ("email", "ip", "card", "phone")
#: What each kind matches. Where a run of characters can be entered in its middle, a match starts at the run's start or where
#: the last match ended, which changes no match and keeps the search linear; possessive loops keep it off the stack.
REGEX = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be searched for.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: A token with a digit, of any length: what may turn out to be an identifier.
MENTION = r"(?<![A-Za-z0-9_])(?=[A-Za-z_./:#@-]*+[0-9])[A-Za-z0-9_]++(?:[-./:#@][A-Za-z0-9_]++)*+"
#: Name of added spans.
ADDED = "id"

ROUNDS = 3
#: Characters of the text on either side from which a context is read, white space counted once.
CONTEXT = 256
#: Support a pattern must have met (a seed is 1, a sure instance its sureness), how sure a pattern must be to count, and how sure an instance must be to be added.
SUPPORT, PATTERN_SURE, INSTANCE_SURE = 3, 0.6, 0.8
#: Array elements summed at once when match positions are worked out.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def found(text: Column, regex: str, present: Column) -> Column:
    """All matches: array of (start, end, value, before, after); code points, end exclusive.

    `before` and `after` are the ends of the text between this match and its neighbours. A match starts at the
    sum of what is before it; sums are kept per `BLOCK` matches, so many matches don't cost their square.
    """
    cut = F.struct(F.split(text, regex, -1).alias("p"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("v"))
    blocks = lambda c: F.sequence(F.lit(0), (F.size(c["v"]) / BLOCK).cast("int"))

    def one(c: Column, steps: Column, starts: Column, x: Column, i: Column) -> Column:
        b = (i / BLOCK).cast("int")
        start = F.get(starts, b) + total(F.slice(steps, b * BLOCK + 1, i - b * BLOCK)) + F.length(F.get(c["p"], i))
        gap = lambda k: F.regexp_replace(F.get(c["p"], k), r"\s+", " ")
        around = [F.right(gap(i), F.lit(CONTEXT)).alias("before"), F.left(gap(i + 1), F.lit(CONTEXT)).alias("after")]
        return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"), *around)

    def placed(c: Column) -> Column:
        steps = F.transform(c["v"], lambda x, i: F.length(x) + F.length(F.get(c["p"], i)))
        return let(steps, lambda t: let(
            F.transform(blocks(c), lambda b: total(F.slice(t, b * BLOCK + 1, F.lit(BLOCK)))),
            lambda sums: let(
                F.transform(blocks(c), lambda b: total(F.slice(sums, F.lit(1), b))),
                lambda starts: F.transform(c["v"], lambda x, i: one(c, t, starts, x, i)),
            ),
        ))

    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    return F.when(present, let(cut, placed)).otherwise(empty)


def luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def holds(kind: str, m: Column) -> Column:
    """Whether a match of the kind's expression is one of the kind."""
    value = m["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(value) - F.length(F.translate(value, "0123456789", ""))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(count.between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return count.between(8, 15)
    return F.lit(True)


def words_around(m: Column) -> list[Column]:
    """Patterns of a match: its two words to the left; its word to the left and its word to the right."""
    left = F.regexp_extract(F.lower(m["before"]), r"(\S+)\s*\z", 1)
    left2 = F.regexp_extract(F.lower(m["before"]), r"(\S+\s+\S+)\s*\z", 1)
    right = F.regexp_extract(F.lower(m["after"]), r"\A\s*(\S+)", 1)
    two = F.when(left2 != "", F.concat(F.lit("L "), F.regexp_replace(left2, r"\s+", " ")))
    both = F.when((left != "") & (right != ""), F.concat(F.lit("LR "), left, F.lit(" "), right))
    return [two, both]


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, key, one array per kind, mentions) of every row; written once. A null text is an empty one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"), text_key(text).alias("key"))
    kinds = []
    for kind in KINDS:
        present = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(HINT[kind])
        kinds.append(F.filter(found(F.col("text"), REGEX[kind], present), partial(holds, kind)).alias(kind))
    mentions = found(F.col("text"), MENTION, F.col("text").rlike("[0-9]"))
    return cut_lineage(rows.select("doc_id", "key", *kinds, mentions.alias("mentions")))


def score_instances(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, sure) of the instances to add, from edges (pattern, instance, seed).

    A seed is sure (1) throughout. A pattern's sureness is the mean of its distinct instances', times s / (s + 1) for its support
    s, the sum over its seeds and its instances of `INSTANCE_SURE` or more; it counts only from `SUPPORT` and `PATTERN_SURE` on. Another
    instance's is 1 - product(1 - pattern's). So instances found in one round make new patterns in the next.
    """
    edges = cut_lineage(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    sure = None
    for _ in range(rounds):
        own = F.col("seed").cast("double")
        known = edges.withColumn("own", own) if sure is None else edges.join(sure, "instance", "left").withColumn("own", F.coalesce(F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("sure")), F.lit(0.0))).drop("sure")
        patterns = known.groupBy("pattern").agg(F.avg("own").alias("mean"), F.sum(F.when(F.col("seed") | (F.col("own") >= INSTANCE_SURE), F.col("own")).otherwise(0.0)).alias("s"))
        patterns = patterns.filter(F.col("s") >= SUPPORT).select("pattern", (F.col("mean") * F.col("s") / (F.col("s") + 1)).alias("p")).filter(F.col("p") >= PATTERN_SURE)
        raised = edges.filter(~F.col("seed")).join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))).alias("sure"))
        sure = cut_lineage(raised)
    return sure.filter(F.col("sure") >= INSTANCE_SURE)


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`: doc_id, key (of the text), n_email, n_ip, n_card, n_phone, base, added.

    `base` and `added` are arrays of (kind, start, end), code points, end exclusive; by kind, then start. Kinds may
    overlap each other. A null text has none. Added spans overlap no base span; equal texts get equal spans.
    """
    rows = scan(docs)
    named = lambda k: F.transform(k, lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    base = F.concat(*[named(k) for k in KINDS])

    texts = rows.filter(" or ".join(f"size({k}) > 0" for k in (*KINDS, "mentions"))).dropDuplicates(["key"])
    seeds = texts.select(F.explode(F.concat(*KINDS)).alias("m"), F.lit(True).alias("seed"))
    covered = lambda m: F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    free = texts.filter("size(mentions) > 0").select("key", base.alias("base"), F.explode("mentions").alias("m")).filter(~covered(F.col("m"))).select("key", "m")
    others = free.select("m", F.lit(False).alias("seed"))
    edges = seeds.unionByName(others).select(F.lower("m.value").alias("instance"), "seed", F.explode(F.array(*words_around(F.col("m")))).alias("pattern")).filter("pattern is not null")
    accepted = score_instances(edges, rounds)

    place = F.struct(F.lit(ADDED).alias("kind"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))
    more = free.withColumn("instance", F.lower("m.value")).join(accepted, "instance").groupBy("key").agg(F.sort_array(F.collect_set(place)).alias("added"))
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.join(more, "key", "left").select("doc_id", "key", *counts, base.alias("base"), F.coalesce("added", nothing).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(new, F.concat(a["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(a["out"]).alias("out"))

    end = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(order, start, step, end)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs`, all spans masked in `text`."""
    key, spans = fresh(docs, "text_key"), fresh(docs, "spans")
    hits = find(docs).select(F.col("key").alias(key), F.concat("base", "added").alias(spans)).filter(F.size(spans) > 0).dropDuplicates([key])
    joined = docs.withColumn(key, text_key("text")).join(hits, key, "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    text = masked(F.col("text"), F.coalesce(F.col(spans), none))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
