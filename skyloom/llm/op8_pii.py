"""Operator 8: personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base patterns give the seeds: addresses, cards and phones that hold by themselves, and, as a kind of their own, secrets: long values of letters and
digits in quotes behind = or a colon. Each mention, seed or candidate of a fitting shape, is an instance; the word to its left, the word to its right, and
both together are lexical patterns of its kind, however long the words are. Over the pattern-instance graph, rounds run: a pattern is scored by the share of its distinct
instances that are trusted; patterns with a high share and enough trusted instances are kept, and what they extract
becomes trusted, until a round adds no pattern. A phone number of bare digits has a shape that says little: it doesn't count against a pattern, and
is extracted where the trusted instances have the high share with the bare ones counted too. Candidates are looked for in what base spans leave of the text;
those that a kept pattern extracts are added to the base spans. Kept spans of the base never go; a secret is a span only if a kept pattern extracts it.

Null texts count as empty: no spans, the digest of the empty string. Repeated rows and null ids are kept. Offsets are code points, ends
exclusive. Positions are running sums in blocks, so a text with very many matches takes time in proportion to it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, packed, table

#: The base kinds in their order, and the one that only patterns find.
BASE_KINDS, KINDS = ("email", "ip", "card", "phone"), ("email", "ip", "card", "phone", "secret")
_LOCAL = "A-Za-z0-9._%+-"
_TOKEN = "A-Za-z0-9+/_-"
#: The base patterns; repeats are possessive where giving back can't help, so long runs need no stack.
PATTERN = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text that lacks this can't hold a match that counts; the patterns proper run only on the others.
NEEDS = {"email": r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_DOT = r" ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)) ?"
#: Shapes of candidates: what a base pattern may miss.
CANDIDATE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?(?:\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])",
    "number": r"(?<![A-Za-z0-9])[0-9](?:[\x20().-]{0,2}[0-9]){7,18}(?![A-Za-z0-9])",
    "secret": rf"(?<![{_TOKEN}])(?=[{_TOKEN}]*[0-9])(?=[{_TOKEN}]*[A-Za-z])[{_TOKEN}]{{16,}}+={{0,2}}",
}
CANDIDATE_NEEDS = {"email": r"[(\[{]at[)\]}]", "ip": rf"[0-9]{_DOT}[0-9]", "number": r"[0-9](?:[\x20().-]{0,2}[0-9]){7}", "secret": rf"[0-9][{_TOKEN}]{{8}}|[{_TOKEN}]{{8}}[0-9]"}
#: The nearest word before and after a mention, past what isn't one.
_LEFT, _RIGHT = r"(?<![\p{L}\p{N}])([\p{L}\p{N}]++)[^\p{L}\p{N}]*+\z", r"^[^\p{L}\p{N}]*+([\p{L}\p{N}]++)"
#: Words longer than so many characters stand in a pattern as their digest.
LONG_WORD = 64
#: A pattern is kept with so many distinct trusted instances and such a share of them.
LEAST_TRUSTED, LEAST_SHARE = 5, 0.8
#: Array elements that one step of a running sum or of a replacement goes through.
BLOCK = 128
#: What stands for a character of a base span while candidates are looked for; in no candidate and no word.
_FILL = "\x01"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once."""
    return F.transform(F.array(value), f)[0]


def _starts(n: Column) -> Column:
    """0, BLOCK, 2 BLOCK and so on, below ``n``; 0 for none."""
    return F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK))


def running(xs: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of ints above or at zero. An array grows by copying, so only short ones grow: totals within blocks, then over blocks."""
    none = F.array().cast("array<int>")

    def step(a, x):
        t = combine(a["t"], x)
        return F.struct(t.alias("t"), F.concat(a["out"], F.array(t)).alias("out"))

    def over(a, b):
        return F.struct(combine(a["t"], b["t"]).alias("t"), F.concat(a["out"], F.array(F.struct(a["t"].alias("t"), b["out"].alias("out")))).alias("out"))

    def whole(xs):
        blocks = F.transform(_starts(F.size(xs)), lambda at: F.aggregate(F.slice(xs, at + 1, F.lit(BLOCK)), F.struct(F.lit(0).alias("t"), none.alias("out")), step))
        before = F.aggregate(blocks, F.struct(F.lit(0).alias("t"), F.array().cast("array<struct<t: int, out: array<int>>>").alias("out")), over, lambda a: a["out"])
        return F.flatten(F.transform(before, lambda b: F.transform(b["out"], lambda x: combine(b["t"], x))))

    return _let(xs, whole)


def _word(gap: Column, pattern: str) -> Column:
    word = F.lower(F.regexp_extract(gap, pattern, 1))
    return F.when(F.length(word) > LONG_WORD, F.sha2(word, 256)).otherwise(word)


def matches(text: Column, pattern: str, needs: str, context: bool = False) -> Column:
    """Leftmost non-overlapping matches as (s, e, m); positions are sums of the lengths of gaps and matches. With ``context`` also
    the words to the left and right ('' for none) and whether it's a quoted value behind = or a colon."""
    more = ", left: string, right: string, quoted: boolean" if context else ""

    def spans(found: Column) -> Column:
        ends = running(F.zip_with(found["m"], F.slice(found["g"], 1, F.size(found["m"])), lambda m, g: F.length(m) + F.length(g)), lambda a, x: a + x)

        def told(m: Column, at: Column, e: Column) -> Column:
            here, after = F.get(found["g"], at), F.get(found["g"], at + 1)
            extra = (_word(here, _LEFT).alias("left"), _word(after, _RIGHT).alias("right"), (here.rlike("[=:]\\s{0,3}[\"']\\z") & after.rlike("^[\"']")).alias("quoted")) if context else ()
            return F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m"), *extra)

        return _let(ends, lambda ends: F.transform(found["m"], lambda m, at: told(m, at, F.get(ends, at))))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    return F.when(text.rlike(needs), _let(found, spans)).otherwise(F.array().cast(f"array<struct<s: int, e: int, m: string{more}>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = d * 2
        return total + F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    m = span["m"]
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame, text_col: str = "text", context: bool = False) -> DataFrame:
    """``docs`` with _t, the text, and _email, _ip, _card, _phone: arrays of what :func:`matches` gives."""
    text = docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    raw = text.select("*", *(matches(F.col("_t"), PATTERN[k], NEEDS[k], context).alias(f"_raw_{k}") for k in BASE_KINDS))
    return raw.select("*", *(F.filter(f"_raw_{k}", partial(_valid, k)).alias(f"_{k}") for k in BASE_KINDS)).drop(*(f"_raw_{k}" for k in BASE_KINDS))


_PLACED = "array<struct<kind: string, s: int, e: int>>"


def disjoint(spans: Column) -> Column:
    """Spans (kind, s, e) in order, overlapping ones as one of the first one's kind."""

    def merged(o: Column, top: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(o) - 1), lambda i: (i == 0) | (F.get(o, i)["s"] >= F.get(top, i - 1)))

        def told(at: Column) -> Column:
            end = lambda j: F.coalesce(F.get(top, F.get(at, j + 1) - 1), F.element_at(top, -1))
            return F.transform(at, lambda i, j: F.struct(F.get(o, i)["kind"].alias("kind"), F.get(o, i)["s"].alias("s"), end(j).alias("e")))

        return _let(firsts, told)

    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("back"), x["kind"].alias("kind"))))
    tops = lambda o: _let(running(F.transform(o, lambda x: -x["back"]), F.greatest), lambda top: merged(o, top))
    return F.when(F.size(spans) == 0, F.array().cast(_PLACED)).otherwise(_let(ordered, tops))


def replaced(text: Column, spans: Column, put: Callable[[Column], Column]) -> Column:
    """``text`` with each of its disjoint spans, in order, replaced by what ``put`` makes of it; some spans and their part of the text at a time."""

    def whole(x: Column) -> Column:
        text, spans = x["t"], x["x"]

        def block(at: Column) -> Column:
            some = F.slice(spans, at + 1, F.lit(BLOCK))
            start = F.coalesce(F.get(spans, at - 1)["e"], F.lit(0))

            def parts(y: Column) -> Column:
                some, part, start = y["some"], y["part"], y["start"]
                since = lambda i: F.coalesce(F.get(some, i - 1)["e"], start)
                return F.array_join(F.transform(some, lambda s, i: F.concat(F.substring(part, since(i) - start + 1, s["s"] - since(i)), put(s))), "")

            part = F.substring(text, start + 1, F.element_at(some, -1)["e"] - start)
            return _let(F.struct(some.alias("some"), part.alias("part"), start.alias("start")), parts)

        tail = F.substring(text, F.element_at(spans, -1)["e"] + 1, F.length(text))
        return F.concat(F.array_join(F.transform(_starts(F.size(spans)), block), ""), tail)

    return F.when(F.size(spans) == 0, text).otherwise(_let(F.struct(text.alias("t"), spans.alias("x")), whole))


def _placed(kind: str, x: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))


def _shape(found: str, m: Column) -> Column:
    """The kind a candidate's shape fits; null for none."""
    if found != "number":
        return F.lit(found)
    n = F.length(_digits(m))
    return (
        F.when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), F.lit("ip"))
        .when(n.between(16, 19) & m.rlike(r"^[0-9]+(?:[ -][0-9]+)*$"), F.lit("card"))
        .when(n.between(8, 15), F.lit("phone"))
    )


def _told(kind: Column, x: Column, seed: Column) -> Column:
    """A mention: kind, s, e, m (a digest), pats (its lexical patterns), bare, seed."""
    left, right = x["left"], x["right"]
    pats = F.filter(F.array(F.when(left != "", F.concat(F.lit("L "), left)), F.when(right != "", F.concat(F.lit("R "), right)), F.when((left != "") & (right != ""), F.concat(F.lit("B "), left, F.lit(" "), right))), lambda p: p.isNotNull())
    bare = (kind == "phone") & x["m"].rlike("^[0-9]+$")
    return F.struct(kind.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.sha2(F.lower(x["m"]), 256).alias("m"), pats.alias("pats"), bare.alias("bare"), seed.alias("seed"))


def _seed(kind: str, x: Column) -> Column:
    return _told(F.lit(kind), x, F.lit(True))


def _fits(found: str, x: Column) -> Column:
    return _shape(found, x["m"]).isNotNull()


def _candidate(found: str, x: Column) -> Column:
    return _told(_shape(found, x["m"]), x, x["quoted"] if found == "secret" else F.lit(False))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, base and cands (arrays of :func:`_told`), key (id and text as a digest, where there are candidates)."""
    based = with_base_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), context=True)
    spans = F.concat(*(F.transform(f"_{k}", partial(_placed, k)) for k in BASE_KINDS))
    left = based.withColumn("_left", replaced(F.col("_t"), disjoint(spans), lambda x: F.repeat(F.lit(_FILL), x["e"] - x["s"])))
    found = left.select("*", *(matches(F.col("_left"), CANDIDATE[c], CANDIDATE_NEEDS[c], True).alias(f"_c_{c}") for c in CANDIDATE))
    base = F.concat(*(F.transform(f"_{k}", partial(_seed, k)) for k in BASE_KINDS))
    cands = F.concat(*(F.transform(F.filter(f"_c_{c}", partial(_fits, c)), partial(_candidate, c)) for c in CANDIDATE))
    told = found.select("doc_id", "_t", base.alias("base"), cands.alias("cands"))
    return told.select("doc_id", "base", "cands", F.when(F.size("cands") > 0, _key(F.col("doc_id"), F.col("_t"))).alias("key"))


def _key(doc_id: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|"), text), 256)


def discovered(told: DataFrame, least_trusted: int = LEAST_TRUSTED, least_share: float = LEAST_SHARE) -> DataFrame:
    """(key, kind, s, e): candidates that kept patterns extract. ``told``: a written table of :func:`mentions`."""
    found = told.select(F.explode(F.concat("base", "cands")).alias("x")).select("x.kind", F.explode("x.pats").alias("pat"), "x.m", "x.seed", "x.bare")
    graph = materialize(found.groupBy("kind", "pat", "m").agg(F.max("seed").alias("trusted"), F.max(F.col("bare") & ~F.col("seed")).alias("bare")), "pii-graph")
    count = lambda c: F.sum(c.cast("long"))
    extracts = ~F.col("bare") | F.col("wide")
    before = None
    while True:
        counted = graph.groupBy("kind", "pat").agg(count(F.col("trusted") | ~F.col("bare")).alias("n"), F.count("*").alias("n_all"), count(F.col("trusted")).alias("ok"))
        kept = counted.filter((F.col("ok") >= least_trusted) & (F.col("ok") >= least_share * F.col("n")))
        patterns = materialize(kept.select("kind", "pat", (F.col("ok") >= least_share * F.col("n_all")).alias("wide")), "pii-patterns")
        # trust only grows, and so do both counts, up to the number of patterns: the rounds end
        now = patterns.agg(F.count("*"), F.coalesce(count(F.col("wide")), F.lit(0))).first()
        if now == before:
            break
        before = now
        # what kept patterns extract is trusted wherever it stands
        more = graph.join(patterns, ["kind", "pat"]).filter(extracts).select("kind", "m").distinct().withColumn("more", F.lit(True))
        graph = materialize(graph.join(more, ["kind", "m"], "left").select("kind", "pat", "m", (F.col("trusted") | F.coalesce("more", F.lit(False))).alias("trusted"), "bare"), "pii-graph")
    open_ = told.filter(F.col("key").isNotNull()).select("key", F.explode("cands").alias("x")).select("key", "x.kind", "x.s", "x.e", (F.col("x.bare") & ~F.col("x.seed")).alias("bare"), F.explode("x.pats").alias("pat"))
    return open_.join(patterns, ["kind", "pat"]).filter(extracts).select("key", "kind", "s", "e").distinct()


def _is(kind: str, x: Column) -> Column:
    return x["kind"] == kind


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _in_order(spans: Column) -> Column:
    """By kind as listed, then start."""
    one = lambda k: F.sort_array(F.transform(F.filter(spans, partial(_is, k)), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.concat(*(one(k) for k in KINDS))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added): arrays of (kind, s, e)."""
    told = materialize(mentions(docs, id_col, text_col), "pii-mentions")
    added = discovered(told).groupBy("key").agg(F.collect_list(F.struct("kind", "s", "e")).alias("added"))
    slim = told.select("doc_id", "key", F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"))).alias("base"))
    none = F.array().cast(_PLACED)
    plain = slim.filter(F.col("key").isNull()).select("doc_id", "base", none.alias("added"))
    joined = slim.filter(F.col("key").isNotNull()).join(added, "key", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))
    return plain.unionByName(joined)


def spans_report(found: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of base spans, all spans (secrets after the kinds of the base), n_added."""
    return found.select(
        "doc_id",
        *(F.size(F.filter("base", partial(_is, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(_said(_in_order(F.col("base"))), 256).alias("base_sha256"),
        _said(_in_order(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_report(find(table(spark, sf_dir, "documents")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with every span replaced by its kind in brackets; overlapping spans are one. A null text stays null."""
    told = materialize(mentions(docs), "pii-mentions")
    added = discovered(told).groupBy("key").agg(F.collect_list(F.struct("kind", "s", "e")).alias("added"))
    none = F.array().cast(_PLACED)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # only texts that may hold a candidate have a key; the others needn't be joined
    open_ = reduce(lambda a, b: a | b, (text.rlike(p) for p in CANDIDATE_NEEDS.values()))
    rows = packed(docs)
    plain = rows.filter(~open_).select("row", none.alias("added"))
    joined = rows.filter(open_).withColumn("key", _key(F.col("row.doc_id"), text)).join(added, "key", "left").select("row", F.coalesce("added", none).alias("added"))
    spans = with_base_spans(plain.unionByName(joined), "row.text")
    done = spans.withColumn("_all", F.concat(*(F.transform(f"_{k}", partial(_placed, k)) for k in BASE_KINDS), "added"))
    shown = replaced(F.col("_t"), disjoint(F.col("_all")), lambda x: F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
    new = F.when(F.col("row.text").isNotNull(), shown)
    return done.select(*((new if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))
