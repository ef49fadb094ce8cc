"""Personal data by fixed patterns and bootstrapped contextual extraction, in DataFrame expressions only.

Fixed matches are the seeds. A candidate is a run of words that hold a digit or ``@``; its left and right
neighbour words are its lexical patterns. Patterns and candidates form a graph that is scored in rounds, until no
pattern or instance is new and the scores have stopped to rise:

    confidence(pattern) = sum of the scores of its candidates' occurrences / all occurrences of its word
    score(candidate)    = 1 - product over its confident patterns of (1 - confidence)

Seeds keep score 1. A pattern counts if ``SUPPORT`` different candidates back it. A word that mostly stands
beside ordinary words (``the``) has hardly any confidence, because its occurrences in all texts are counted.
Candidates with six digits or an ``@`` and a score of ``ACCEPT`` or more are reported as ``learned``.

Regular expressions are possessive and start at run boundaries, so their cost is linear in the text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import unit_key
from forecourt.sources import scratch

# Kinds, their order and patterns. A match starts where a run starts or the last match ended.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = ("email", "ip", "card", "phone", "learned")
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text with a match holds at least.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_IN, _PLAIN = r"[^\x20\x09-\x0D]", r"[^\x20\x09-\x0D0-9@]"
_WORD = rf"(?<!{_IN}){_PLAIN}*+[0-9@]{_IN}*+"
RUN = rf"{_WORD}(?: {_WORD})*+"

SUPPORT, CONFIDENT, ACCEPT = 3, 0.5, 0.8
#: Rise of all scores together below which a round has changed nothing.
STILL = 1e-3
_STEP = 256


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.length(turned)),
        lambda i: (F.ascii(F.substr(turned, i, F.lit(1))) - 48) * (2 - i % 2),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often and deep in lambdas the body uses it."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, needs: str, *more) -> Column:
    """Array of ``start, end, match`` (code points) of the non-overlapping matches of ``pattern``, and what ``more``
    makes of the pieces of text before and behind each match. A text without the simple pattern ``needs``, which is
    part of every match, is not searched.

    Offsets are sums of the lengths of matches and of the pieces between; sums of ``_STEP`` terms are kept, so
    the cost stays linear in the number of matches.
    """
    total = lambda array: F.aggregate(array, F.lit(0), lambda a, v: a + v)

    def sized(x):
        sizes = F.transform(x["hits"], lambda h, i: F.length(h) + F.length(x["gaps"][i]))
        return F.struct(x["hits"].alias("hits"), x["gaps"].alias("gaps"), sizes.alias("sizes"))

    def marked(x):
        steps = F.sequence(F.lit(1), F.greatest(F.size(x["hits"]), F.lit(1)), F.lit(_STEP))
        marks = F.aggregate(
            steps, F.array(F.lit(0)), lambda a, i: F.array_append(a, F.element_at(a, -1) + total(F.slice(x["sizes"], i, F.lit(_STEP))))
        )
        return F.struct(*[x[f].alias(f) for f in ("hits", "gaps", "sizes")], marks.alias("marks"))

    def spans(x):
        def span(hit, i):
            whole = F.floor(i / _STEP).cast("int")
            start = x["marks"][whole] + total(F.slice(x["sizes"], whole * _STEP + 1, i % _STEP)) + F.length(x["gaps"][i])
            extra = [f(x["gaps"][i], x["gaps"][i + 1]) for f in more]
            return _let(start, lambda at: F.struct(at.alias("start"), (at + F.length(hit)).alias("end"), hit.alias("match"), *extra))

        return F.transform(x["hits"], span)

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, F.lit(pattern), -1).alias("gaps"))
    listed = _let(found, lambda x: _let(sized(x), lambda y: _let(marked(y), spans)))
    return F.coalesce(F.when(text.rlike(needs), listed), F.array())


def _neighbour(piece: Column, last: bool) -> Column:
    """The last or first word of a piece of text, letters only, small; ``^`` or ``$`` at the end of the text.

    The whole piece is looked at, however wide the gap to the word.
    """
    spaced = F.translate(piece, "\t\n\x0b\x0c\r", "     ")
    word = F.substring_index(F.rtrim(spaced), " ", -1) if last else F.substring_index(F.ltrim(spaced), " ", 1)
    return _bare(word)


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[^\p{L}]", "")


def _fixed(text: Column, k: int, kind: str) -> Column:
    """Valid matches of a kind: ``kind, start, end``."""
    valid = F.filter(matches(text, PATTERNS[kind], NEEDS[kind]), lambda m: _valid(kind, m["match"]))
    return F.transform(valid, lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _number(k: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")


def _found(docs: DataFrame) -> DataFrame:
    """Per row: key, hash of the text, fixed spans and candidate runs with their neighbours."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", unit_key().alias("key"), F.xxhash64(text).alias("h"), text.alias("t"))
    t = F.col("t")
    fixed = F.concat(*[_fixed(t, k, kind) for k, kind in enumerate(PATTERNS)])
    sides = [lambda before, _: _neighbour(before, True).alias("left"), lambda _, behind: _neighbour(behind, False).alias("right")]
    rows = rows.select("doc_id", "key", "h", F.struct(fixed.alias("fixed"), matches(t, RUN, "[0-9@]", *sides).alias("run")).alias("x"))

    def candidate(x, m):
        seed = F.exists(x["fixed"], lambda s: (s["start"] < m["end"]) & (s["end"] > m["start"]))
        digits = F.length(F.regexp_replace(m["match"], "[^0-9]", ""))
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.xxhash64(F.lower(m["match"])).alias("instance"),
            seed.alias("seed"),
            (~seed & ((digits >= 6) | m["match"].contains("@"))).alias("open"),
            m["left"].alias("left"),
            m["right"].alias("right"),
        )

    both = _let(
        F.col("x"),
        lambda x: F.struct(x["fixed"].alias("fixed"), F.transform(x["run"], lambda m: candidate(x, m)).alias("runs")),
    )
    return rows.select("doc_id", "key", "h", both.alias("y")).select("doc_id", "key", "h", "y.*")


def _learned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Instances that confident patterns discover: ``instance``."""
    runs = found.select(F.explode("runs").alias("r")).select("r.*")
    sides = F.array(F.struct(F.lit("l").alias("side"), F.col("left").alias("word")), F.struct(F.lit("r").alias("side"), F.col("right").alias("word")))
    edges = runs.select("instance", "seed", "open", F.explode(sides).alias("p")).select("instance", "seed", "open", "p.*")
    edges = edges.where("word != ''").groupBy("instance", "side", "word").agg(
        F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"), F.max("open").alias("open")
    )
    words = docs.select(F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    totals = words.groupBy(_bare(F.col("w")).alias("word")).agg(F.sum("n").alias("total"))
    # Every word beside a candidate is counted: a pattern may have no seed and gain support from discovered instances.
    edges = scratch.materialise(edges, "edges")
    totals = scratch.materialise(totals.join(edges.select("word").distinct(), "word", "left_semi"), "totals")
    # ``given`` tells seeds from instances whose score is rounded to 1.
    seeds = edges.where("seed").select("instance").distinct().select("instance", F.lit(1.0).alias("score"), F.lit(True).alias("given"))
    seeds = scratch.materialise(seeds, "seeds")
    scores, before = seeds, None
    while True:
        weighted = edges.join(scores, "instance").groupBy("side", "word").agg(
            F.sum(F.col("score") * F.col("n")).alias("mass"), F.sum("score").alias("support")
        )
        patterns = weighted.where(F.col("support") >= SUPPORT).join(totals, "word").withColumn("confidence", F.col("mass") / F.col("total"))
        sure = patterns.where(F.col("confidence") >= CONFIDENT)
        sure = scratch.materialise(sure.select("side", "word", F.least("confidence", F.lit(0.99)).alias("confidence")), "patterns")
        new = edges.where("open AND NOT seed").join(sure, ["side", "word"]).groupBy("instance")
        new = new.agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"), F.lit(False).alias("given"))
        new = scratch.materialise(new.join(seeds, "instance", "left_anti").select(*seeds.columns), "scores")
        # Scores never fall from round to round, so the sets only grow and the sum has a limit.
        sums = new.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0.0)), F.count_if(F.col("score") >= ACCEPT)).first()
        now = (sure.count(), sums[0], sums[2]), sums[1]
        scores = seeds.unionByName(new)
        if before is not None and now[0] == before[0] and now[1] - before[1] < STILL:
            break
        before = now
    return scores.where((F.col("score") >= ACCEPT) & ~F.col("given")).select("instance")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_learned, base_sha256, spans, found`` for every row of ``docs``.

    ``found`` holds ``kind, start, end`` (a place in ``KINDS``; code points, end exclusive) of all spans, by kind, then
    start; ``spans`` lists them as ``kind:start:end``, ``base_sha256`` is the digest of that list of the fixed spans.
    Fixed spans always stay; learned ones overlap none of them. A null text is empty. Null and repeated ids are
    scanned row by row; other columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    found = scratch.materialise(_found(docs), "pii")
    learned = found.select("key", "h", F.explode("runs").alias("r")).where("r.open").select("key", "h", "r.start", "r.end", "r.instance")
    learned = learned.join(_learned(docs, found), "instance", "left_semi").select("key", "h", "start", "end").distinct()
    span = F.struct(F.lit(4).alias("kind"), "start", "end")
    learned = learned.groupBy("key", "h").agg(F.array_sort(F.collect_list(span)).alias("more"))
    joined = found.select("doc_id", "key", "h", "fixed").join(learned, ["key", "h"], "left")
    joined = joined.withColumn("found", F.when(F.col("more").isNull(), F.col("fixed")).otherwise(F.concat("fixed", "more")))
    counts = [_number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return joined.select("doc_id", *counts, F.sha2(_listed(F.col("fixed")), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"), "found")
