"""Personal data: base identifiers by pattern, more of them by bootstrapped contexts. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodgewise.llm.common import written

KINDS = ("email", "ip", "card", "phone")
_CHUNK = 1024  # code points
_MARK, _OTHER = "\ue000", "\ue001"  # stands for a joint inside an identifier; what stands for it where a text holds it


def _let(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body`."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, most: bool = False) -> Column:
    """For each value the sum (or the maximum, at least 0) of all before it. Blocks as long as the root of their number
    are added up once, so n values take n times the root of n steps."""

    def total(some: Column) -> Column:
        return F.coalesce(F.array_max(some), F.lit(0)) if most else F.aggregate(some, F.lit(0), lambda a, x: a + x)

    def both(x: Column, y: Column) -> Column:
        return F.greatest(x, y) if most else x + y

    def walk(s: Column) -> Column:
        v, b = s["v"], s["b"]
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / b).cast("int")), lambda k: total(F.slice(v, k * b + 1, b)))
        before = _let(blocks, lambda t: F.transform(t, lambda x, k: total(F.slice(t, F.lit(1), k))))
        return _let(before, lambda t: F.transform(v, lambda x, i: both(F.get(t, F.floor(i / b).cast("int")), total(F.slice(v, i - i % b + 1, i % b)))))

    root = F.ceil(F.sqrt(F.size(values))).cast("int")
    return F.when(F.size(values) > 0, _let(F.struct(values.alias("v"), root.alias("b")), walk)).otherwise(F.array().cast("array<int>"))


def _found(text: Column, pattern: str, kind: int, good=None) -> Column:
    """Matches from left to right with their places: array of (start, kind, end, value), in code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gaps")
    pieces = F.struct(gaps, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))

    def place(s: Column) -> Column:
        steps = F.transform(s["match"], lambda m, i: F.get(s["gaps"], i) + F.length(m))

        def one(before: Column):
            def span(m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.get(s["gaps"], i)
                return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(m)).alias("end"), m.alias("value"))

            return span

        return _let(_running(steps), lambda before: F.transform(s["match"], one(before)))

    spans = _let(pieces, place)
    return F.filter(spans, lambda x: good(x["value"])) if good else spans


def _chunks(text: Column) -> Column:
    """The text in parts of _CHUNK code points, so that a place in a long one is reached without counting from its start."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % _CHUNK), F.lit(0))


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The text from one place to another."""
    size = F.lit(_CHUNK)
    first, last = F.floor(start / size).cast("int"), F.floor(end / size).cast("int")
    chunk = lambda i: F.coalesce(F.get(chunks, i), F.lit(""))
    inside = F.substr(chunk(first), start % size + 1, end - start)
    across = F.concat(
        F.substr(chunk(first), start % size + 1, size), F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substr(chunk(last), F.lit(1), end % size)
    )
    return F.when(end <= start, F.lit("")).when(first == last, inside).otherwise(across)


def _below(sorted_values: Column, limit: Column) -> Column:
    """How many values of a sorted array lie below a limit, by halving."""
    ends = F.struct(F.lit(0).alias("lo"), F.size(sorted_values).alias("hi"))

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        less = (a["lo"] < a["hi"]) & (F.get(sorted_values, middle) < limit)
        return F.struct(F.when(less, middle + 1).otherwise(a["lo"]).alias("lo"), F.when(less, a["hi"]).otherwise(F.least(middle, a["hi"])).alias("hi"))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_values) + 1)).cast("int"))
    return F.aggregate(rounds, ends, halve)["lo"]


def _apart(loose: Column, base: Column) -> Column:
    """The loose spans that overlap no base span; base spans are sorted by start."""

    def keep(s: Column) -> Column:
        # furthest[i]: the furthest end of the first i base spans
        return F.filter(s["loose"], lambda x: F.coalesce(F.get(s["furthest"], _below(s["starts"], x["end"])), F.lit(0)) <= x["start"])

    ends = F.transform(base, lambda y: y["end"])
    furthest = _running(F.concat(ends, F.array(F.lit(0))), most=True)
    held = F.struct(loose.alias("loose"), F.transform(base, lambda y: y["start"]).alias("starts"), furthest.alias("furthest"))
    return F.when((F.size(base) == 0) | (F.size(loose) == 0), loose).otherwise(_let(held, keep))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _card(value: Column) -> Column:
    return F.length(_digits(value)).between(14, 19) & _luhn(_digits(value))


def _octets(value: Column) -> Column:
    short = F.transform(F.split(value, "\\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", ""))
    return F.forall(short, lambda x: (F.length(x) <= 3) & (F.substr(x, F.lit(1), F.lit(3)).cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """Base identifiers, by start and then kind. Joints are marked first, so that no pattern repeats a group:
    Java would need a stack frame for each repetition, and a long enough text would exhaust it."""
    clean = F.when(F.contains(text, F.lit(_MARK)), F.replace(text, F.lit(_MARK), F.lit(_OTHER))).otherwise(text)
    dotted = F.regexp_replace(clean, "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", _MARK)
    local = f"A-Za-z0-9._%+{_MARK}-"
    email = f"(?:\\G|(?<![{local}]))[{local}]+@[A-Za-z0-9-]+{_MARK}[A-Za-z0-9{_MARK}-]+"
    joined = F.regexp_replace(clean, "(?<=[0-9])[ -](?=[0-9])", _MARK)
    all_spans = F.concat(
        F.when(F.contains(text, F.lit("@")), _found(dotted, email, 0)).otherwise(_none()),
        F.when(text.rlike("[0-9]\\.[0-9]"), _found(clean, "(?<![0-9])[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+", 1, _octets)).otherwise(_none()),
        F.when(text.rlike("[0-9][0-9 -]{12}"), _found(joined, f"[0-9][0-9{_MARK}]+", 2, _card)).otherwise(_none()),
        F.when(F.contains(text, F.lit("+")), _found(clean, "\\+[0-9][ ().0-9-]+[0-9]", 3, lambda v: F.length(_digits(v)).between(10, 15))).otherwise(_none()),
    )
    return F.array_sort(all_spans)


def loose_spans(text: Column) -> Column:
    """What looks like an identifier without being a base one: long numbers with separators, handles."""
    number = F.when(text.rlike("[0-9][0-9 ().-]{5}"), _found(text, "(?<![0-9A-Za-z])[0-9][0-9 ().-]{5,30}[0-9](?![0-9A-Za-z])", -1)).otherwise(_none())
    handle = F.when(F.contains(text, F.lit("@")), _found(text, "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}@[A-Za-z0-9-]{2,64}(?![A-Za-z0-9-])", -1)).otherwise(_none())
    return F.concat(number, handle)


def _context(chunks: Column, spans: Column) -> Column:
    """The two words on either side of each span, as patterns."""

    def one(s: Column) -> Column:
        left = F.lower(_cut(chunks, F.greatest(s["start"] - 40, F.lit(0)), s["start"]))
        right = F.lower(_cut(chunks, s["end"], s["end"] + 40))
        return F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.regexp_replace(F.lower(s["value"]), f"[ ().{_MARK}-]", "").alias("instance"),
            F.regexp_extract(left, "(\\S+\\s+\\S+)\\s*$", 1).alias("left"),
            F.regexp_extract(right, "^\\W*(\\w+\\W+\\w+)", 1).alias("right"),
        )

    return F.transform(spans, one)


def extract(docs: DataFrame) -> DataFrame:
    """Written table of one row per row of `docs`: doc_id, key (hash of the text), base and loose spans with contexts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    held = rows.select("doc_id", F.xxhash64("text").alias("key"), F.struct("text", base_spans(F.col("text")).alias("base"), loose_spans(F.col("text")).alias("loose")).alias("s"))

    def apart(s: Column) -> Column:
        spans = F.struct(_chunks(s["text"]).alias("chunks"), s["base"].alias("base"), _apart(s["loose"], s["base"]).alias("loose"))
        known = _let(spans, lambda t: F.struct(_context(t["chunks"], t["base"]).alias("base"), _context(t["chunks"], t["loose"]).alias("loose")))
        return F.when(F.size(s["base"]) + F.size(s["loose"]) > 0, known)

    none = F.array().cast("array<struct<start:int,kind:int,end:int,instance:string,left:string,right:string>>")
    found = held.select("doc_id", "key", _let(F.col("s"), apart).alias("s"))
    return written(found.select("doc_id", "key", F.coalesce("s.base", none).alias("base"), F.coalesce("s.loose", none).alias("loose")), "personal")


def discovered(found: DataFrame, rounds: int = 3, least_seeds: int = 3, least_score: float = 0.8) -> DataFrame:
    """Further identifiers: doc_id, key, extra (array of start, kind, end). Seeds are the base identifiers.

    A pattern is a pair of words before or behind an identifier. In each round a pattern counts for a kind if at least
    `least_seeds` different instances accepted for that kind stand in it; its confidence is the sum of their scores (1 for
    seeds) by the number of its instances. An instance that is no seed scores one minus the product of its patterns'
    doubts, for the kinds that its shape allows, and is accepted for its best kind from `least_score` on. The next round
    counts with what this one accepted, so patterns that hold no seed come in by and by. Long lists of a pattern or an
    instance only meet sums per pattern or instance.
    """
    span = F.explode(F.concat("base", "loose")).alias("s")
    seen = found.filter((F.size("base") > 0) | (F.size("loose") > 0)).select(span)
    sides = F.explode(F.array(F.concat(F.lit("l "), "s.left"), F.concat(F.lit("r "), "s.right"))).alias("pattern")
    edges = seen.select(F.col("s.kind").alias("kind"), F.col("s.instance").alias("instance"), sides).filter("length(pattern) > 2")
    edges = written(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "edges")
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    seeds = edges.filter("kind >= 0").groupBy("instance", "kind").agg(F.lit(1.0).alias("score"))
    free = edges.filter("kind < 0").select("pattern", "instance")
    fits = F.expr("(kind = 0) = contains(instance, '@') AND kind <> 1")  # a handle can be an email, a number a card or phone
    both = edges.select("pattern", "instance")
    accepted, taken = seeds, None
    for _ in range(rounds):
        held = both.join(accepted, "instance").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("mass"))
        known = held.filter(F.col("n") >= least_seeds).join(size, "pattern").select("pattern", "kind", (F.col("mass") / F.col("size")).alias("confidence"))
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
        scores = free.join(known, "pattern").filter(fits).groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        best = scores.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
        taken = written(best.filter(F.col("best.score") >= least_score).select("instance", (-F.col("best.k")).alias("kind"), F.col("best.score").alias("score")), "accepted")
        accepted = seeds.unionByName(taken.select("instance", "kind", "score")).groupBy("instance", "kind").agg(F.max("score").alias("score"))
    loose = found.filter(F.size("loose") > 0).select("doc_id", "key", F.explode("loose").alias("s"))
    hits = loose.select("doc_id", "key", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.instance").alias("instance"))
    hits = hits.join(taken, "instance").select("doc_id", "key", F.struct("start", "kind", "end").alias("s"))
    return hits.groupBy("doc_id", "key").agg(F.collect_set("s").alias("extra"))


def find_personal(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, key, base and all (arrays of start, kind, end by start and kind).

    Whole texts; a null text is empty and has no spans, a null doc_id stays null, repeated rows get the same spans.
    """
    found = extract(docs)
    plain = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).alias("base")
    more = discovered(found).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "extra")
    rows = found.select("doc_id", "key", plain)
    joined = rows.join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left")
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("doc_id", "key", "base", F.array_sort(F.concat("base", F.coalesce("extra", empty))).alias("all"))


def _told(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans as `kind:start:end`."""
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find_personal(docs).select("doc_id", *counts, F.sha2(_told("base"), 256).alias("base_sha256"), _told("all").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The table with every identifier replaced by its kind in square brackets; all columns kept, n_chars brought up to date."""
    spans = find_personal(docs).filter(F.size("all") > 0).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("all").alias("_all")).dropDuplicates(["_d", "_k"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("_key", F.xxhash64(text))
    joined = rows.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def put(held: Column) -> Column:
        ends = F.transform("_all", lambda s: s["end"])
        parts = F.struct(_chunks(held).alias("chunks"), _running(F.concat(ends, F.array(F.length(held))), most=True).alias("gone"), F.length(held).alias("n"))

        def pieces(p: Column) -> Column:
            # gone[i]: how far the spans before reach; one that begins inside them is already gone
            def piece(s: Column, i: Column) -> Column:
                at = F.get(p["gone"], i)
                return F.when(s["start"] >= at, F.concat(_cut(p["chunks"], at, s["start"]), F.get(names, s["kind"]))).otherwise(F.lit(""))

            return F.concat(F.array_join(F.transform("_all", piece), ""), _cut(p["chunks"], F.get(p["gone"], F.size("_all")), p["n"]))

        return _let(parts, pieces)

    new = F.when(F.col("_all").isNull(), F.col("text")).otherwise(put(text))
    out = joined.withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_all").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
