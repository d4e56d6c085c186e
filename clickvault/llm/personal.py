r"""Personal data: fixed patterns, and identifiers found by the contexts they share.

Base: e-mail addresses, IPv4 addresses, payment cards and phone numbers,
leftmost and not overlapping within a kind; matches that fail their check
(parts above 255, Luhn, digit counts) are dropped, not retried.

The method is bootstrapped contextual extraction. Base spans are the seeds.
The words before a span (one, and two) are its lexical patterns, whatever the
span looks like. What stands in a pattern's slot and overlaps no base span is
a candidate: any token, be it letters, digits or both. Patterns and
identifiers make a graph, scored in rounds: a pattern's confidence is the
known share of the distinct identifiers that it stands with; an identifier's
score is one minus the product of its confident patterns' doubts. A token
without a digit or '@' may be a word of the language, so its score is
multiplied by the share of its places that are confident slots. Identifiers
above the threshold are known in the next round, and all their places become
spans of the pattern's kind. Rounds go on until neither the known identifiers
nor their scores (to four digits) change.

A token starts at a word (``ALNUM_WORDS``) before which the text starts or a
separator stands (white space, controls, ``,;:="<>[]{}|``), and goes up to the
last word before the next separator; of longer ones the first ``LONGEST``
words are the token.

Native: base matches are cut out by the patterns themselves, so a match's
place is the sum of the lengths before it; each document leaves that scan as
one row and a row a match, never as text. The texts are staged once for the
token scans, which explode positions inside one generated loop and let out
only those whose context or first word is looked for (hashes, broadcast in
blocks of ``BLOCK``). A pattern's slots are let out only when it can be
confident: the distinct first words of a sixteenth of its slots are a lower
bound of what it stands with. A long text is scanned in runs of ``RUN`` words,
so a row that is let out holds a run, whatever the length of its text. The graph is grouped by pattern and by
identifier over distinct pairs with map-side combine, so an identifier or a
context that fills a third of the corpus is one pair a task.

The patterns below are the contract's with possessive repeats and look-behinds:
they match the same and take time in proportion to the text, and no stack.

Null text: empty. Repeated rows are rows of their own. An empty table gives
no rows; without seeds there are no patterns, and nothing is added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import alnum_words, materialize, pick

KINDS = ["email", "ip", "card", "phone"]
TOKEN = len(KINDS)
LONGEST, RUN, BLOCK, SAMPLE, NEAR, MOST_ROUNDS = 64, 256, 1_000_000, 16, 256, 60
_E = "A-Za-z0-9._%+-"
_SEPARATOR = r'[\x00-\x20\x7F,;:="<>\[\]{}|]'
_ALNUM = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_START = rf"(?<=[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?={_ALNUM})"
_BODY = rf"^(?:[!#-+\-./?@\\^_`~]*+{_ALNUM}++)++"
#: A run of 16 to 19 digits that is not part of a longer one; equal to dropping the others after matching whole runs.
REGEX = [
    rf"(?:\G|(?<![{_E}]))[{_E}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
MARK = ["@", ".", None, "+"]  # a text without it has no match


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether up to 19 digits, separators aside, pass the Luhn check."""
    rev = F.reverse(_digits(value))
    terms = []
    for i in range(19):
        d = F.when(F.length(rev) > i, F.ascii(F.substring(rev, i + 1, 1)) - 48).otherwise(0)
        terms.append(d if i % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return reduce(Column.__add__, terms) % 10 == 0


def passes() -> Column:
    """The check of a match of ``kind``."""
    v, n = F.col("value"), F.length(_digits(F.col("value")))
    small = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return (F.when(F.col("kind") == 0, True).when(F.col("kind") == 1, v.rlike(rf"^{small}(?:\.{small}){{3}}$"))
            .when(F.col("kind") == 2, luhn(v)).otherwise(n.between(8, 15)))


def _pairs(kind: int, found: str) -> Column:
    """The matches of a kind with the text since the match before."""
    gaps = F.split("text", REGEX[kind], -1)
    zipped = F.arrays_zip(F.col(found).alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    return F.coalesce(F.when(F.size(found) > 0, zipped), F.array().cast("array<struct<value:string,gap:string>>"))


def _cut(kind: int, pairs: str) -> Column:
    """The matches of a kind with the length of the text since the match before, and the two words before.

    The words are looked for in the ``NEAR`` characters before the match,
    whatever other matches lie there."""
    tail = lambda c: F.right(c, F.lit(NEAR))
    back = lambda i, n, part: F.coalesce(tail(F.get(pairs, i - n)[part]), F.lit(""))
    text = lambda i: tail(F.concat(*[back(i, n, part) for n in (3, 2, 1) for part in ("gap", "value")], back(i, 0, "gap")))
    one = lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("no"), F.length(x["gap"]).alias("gap"), x["value"].alias("value"),
                                F.slice(F.concat(F.array(F.lit("^"), F.lit("^")), alnum_words(text(i))), -2, 2).alias("before"))
    return F.coalesce(F.transform(pairs, one), F.array().cast(_ROWS))


_ROWS = "array<struct<kind:int,no:int,gap:int,value:string,before:array<string>>>"


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid doc_id text``, staged: several scans must find a row under the same number."""
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "personal-texts")


def places(rows: DataFrame) -> DataFrame:
    """``rid doc_id kind start end value before``: all base spans, and a row a document whose ``kind`` is null."""
    found = {}
    for k in range(len(REGEX)):
        may = F.col("text").contains(MARK[k]) if MARK[k] else F.col("text").rlike("[0-9]")
        found[f"f{k}"] = F.when(may, F.regexp_extract_all("text", F.lit(REGEX[k]), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("rid", "doc_id", "text", *[c.alias(n) for n, c in found.items()])
    # one generated row each, as in with_words: the texts are split once, not for every match
    once = F.array(F.struct(*[_pairs(k, f"f{k}").alias(f"m{k}") for k in range(len(REGEX))]))
    rows = rows.select("rid", "doc_id", F.explode(once).alias("c")).select("rid", "doc_id", "c.*")
    # outer, so documents without a match stay
    cut = rows.select("rid", "doc_id", F.explode_outer(F.concat(*[_cut(k, f"m{k}") for k in range(len(REGEX))], F.array(
        F.lit(None).cast(_ROWS[6:-1])))).alias("m")).select("rid", "doc_id", "m.*")
    order = Window.partitionBy("rid", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(order)
    placed = materialize(cut, "personal-matches").withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return placed.filter(F.col("kind").isNull() | passes()).select("rid", "doc_id", "kind", "start", "end", "value", "before")


def free_tokens(found: DataFrame) -> DataFrame:
    """The tokens that overlap no base span."""
    # the second order is the first one turned round, so both frames only grow
    keys, before = ("start", "end", "kind"), (Window.unboundedPreceding, -1)
    base = F.col("kind") < TOKEN
    ends = F.max(F.when(base, F.col("end"))).over(Window.partitionBy("rid").orderBy(*keys).rowsBetween(*before))
    starts = F.min(F.when(base, F.col("start"))).over(Window.partitionBy("rid").orderBy(*[F.desc(k) for k in keys]).rowsBetween(*before))
    near = found.withColumns({"_e": ends, "_s": starts})
    free = F.coalesce(F.col("_e") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_s") >= F.col("end"), F.lit(True))
    return near.filter(~base & free).drop("_e", "_s")


def edges(spans: DataFrame) -> DataFrame:
    """``pattern value kind``, each pair once; the kind is null for tokens."""
    left = F.col("before")
    patterns = F.array(F.concat_ws(" ", F.get(left, F.lit(0)), F.get(left, F.lit(1))), F.concat_ws(" ", F.lit("*"), F.get(left, F.lit(1))))
    kind = F.when(F.col("kind") < TOKEN, F.col("kind"))
    return spans.select(F.explode(patterns).alias("pattern"), "value", kind.alias("kind")).groupBy("pattern", "value").agg(F.min("kind").alias("kind"))


def positions(rows: DataFrame) -> DataFrame:
    """Every word's position ``i`` with ``a``, ``b``: the two words before,
    and ``word`` itself.

    A text is cut into runs of ``RUN`` words first, so a row carries a run
    and never its whole text: ``p``, the text cut before each word, from
    ``j`` on at the word; ``back``: whether an element before the run is there;
    ``off``: code points before the run."""
    # one generated row each, as in with_words
    cut = F.struct(F.split("text", _START, -1).alias("p"), alnum_words(F.col("text")).alias("w"))
    words = rows.select("rid", F.explode(F.array(cut)).alias("c")).select("rid", "c.p", "c.w").filter(F.size("w") > 0)
    words = words.withColumn("lead", F.size("p") - F.size("w"))
    runs = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / RUN).cast("int"))
    joined = lambda first, n: F.length(F.array_join(F.slice("p", first, n), "")).cast("long")
    lengths = F.transform(runs, lambda c: joined(F.col("lead") + c * RUN + 1, F.lit(RUN)))
    before = F.when(F.col("lead") > 0, joined(F.lit(1), F.col("lead"))).otherwise(F.lit(0).cast("long"))
    words = words.select("rid", "p", "w", "lead", F.explode(F.array(F.struct(lengths.alias("lens"), before.alias("before")))).alias("l"))

    def run(c: Column) -> Column:
        back = F.when(F.col("lead") + c > 0, 1).otherwise(0)
        off = F.aggregate(F.slice(F.col("l.lens"), F.lit(1), c), F.col("l.before"), lambda x, y: x + y)
        return F.struct(c.alias("c"), back.alias("back"), off.alias("off"),
                        F.slice("p", F.col("lead") + c * RUN + 1 - back, F.lit(RUN + LONGEST) + back).alias("p"),
                        F.slice("w", F.greatest(c * RUN - 2, F.lit(0)) + 1, F.lit(RUN) + F.least(c * RUN, F.lit(2))).alias("w"))

    parts = words.select("rid", F.explode(F.transform(runs, run)).alias("r")).select("rid", "r.*")
    held = F.least(F.col("c") * RUN, F.lit(2))  # words of the run before
    at = parts.select("rid", "c", "back", "off", "p", "w", F.explode(F.sequence(F.lit(0), F.size("w") - held - 1)).alias("j"))
    word = lambda n: F.coalesce(F.get("w", F.col("j") + F.least(F.col("c") * RUN, F.lit(2)) - n), F.lit("^"))
    return at.select("rid", (F.col("c") * RUN + F.col("j")).alias("i"), "j", "back", "off", "p", word(2).alias("a"), word(1).alias("b"), word(0).alias("word"))


def starts_token() -> Column:
    return (F.col("i") == 0) | F.get("p", F.col("j") + F.col("back") - 1).rlike(_SEPARATOR)


def as_places(at: DataFrame) -> DataFrame:
    """``rid kind start end value before`` of the tokens at ``positions``."""
    n = F.col("j") + F.col("back")
    value = F.regexp_extract(F.array_join(F.slice("p", n + 1, F.lit(LONGEST)), ""), _BODY, 0)
    start = F.col("off") + F.length(F.array_join(F.slice("p", F.col("back") + 1, F.col("j")), ""))
    return at.filter(starts_token()).select("rid", F.lit(TOKEN).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                                            value.alias("value"), F.array("a", "b").alias("before"))


def _pattern_hash() -> Column:
    return F.xxhash64(F.substring_index("pattern", " ", 1), F.substring_index("pattern", " ", -1))


def _near(at: DataFrame, patterns: DataFrame) -> DataFrame:
    """The positions that stand in a slot of ``patterns``, with ``h``: the hashes of those they stand in."""
    hashes = materialize(patterns.select(_pattern_hash().alias("h")).distinct(), "personal-hashes")
    blocks = -(-hashes.count() // BLOCK) or 1
    keyed = at.withColumns({"two": F.xxhash64("a", "b"), "one": F.xxhash64(F.lit("*"), F.col("b"))})
    out = []
    for k in range(blocks):  # at most BLOCK hashes each
        side = hashes.filter(F.pmod("h", F.lit(blocks)) == k)
        met = (keyed.join(F.broadcast(side.select(F.col("h").alias("two"), F.lit(True).alias("y2"))), "two", "left")
               .join(F.broadcast(side.select(F.col("h").alias("one"), F.lit(True).alias("y1"))), "one", "left").filter("y1 OR y2"))
        out.append(met.withColumn("h", F.array_compact(F.array(F.when(F.col("y2"), F.col("two")), F.when(F.col("y1"), F.col("one"))))).drop("two", "one", "y1", "y2"))
    return reduce(DataFrame.unionByName, out)


def least_totals(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern least``: a lower bound of the distinct values in each pattern's
    slots: the distinct first words of them whose hash falls in a sixteenth."""
    first = F.xxhash64("word")
    at = _near(positions(rows).filter(F.pmod(first, F.lit(SAMPLE)) == 0), patterns).filter(starts_token())
    pairs = at.select(F.explode("h").alias("h"), first.alias("f")).distinct()
    return (patterns.select("pattern", _pattern_hash().alias("h")).join(pairs.groupBy("h").agg(F.count(F.lit(1)).alias("least")), "h", "left")
            .select("pattern", F.coalesce("least", F.lit(0)).alias("least")))


def at_values(rows: DataFrame, values: DataFrame) -> DataFrame:
    """``positions`` where a token starts with the first word of one of ``values``."""
    word = F.xxhash64(F.get(alnum_words(F.col("value")), F.lit(0)))
    firsts = materialize(values.select(word.alias("f")).distinct(), "personal-firsts")
    blocks = -(-firsts.count() // BLOCK) or 1
    at = positions(rows).withColumn("f", F.xxhash64("word"))
    return reduce(DataFrame.unionByName, [at.join(F.broadcast(firsts.filter(F.pmod("f", F.lit(blocks)) == k)), "f", "left_semi") for k in range(blocks)])


def scored(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
    """``pairs`` with kinds and scores of seeds and known identifiers."""
    if known is None:
        return pairs.withColumn("score", F.when(F.col("kind").isNotNull(), F.lit(1.0)))
    return (pairs.join(known, "value", "left").select("pattern", "value", F.coalesce("kind", "found").alias("kind"),
            F.when(F.col("kind").isNotNull(), F.lit(1.0)).otherwise(F.col("known_score")).alias("score")))


def confident(pairs: DataFrame, known: DataFrame | None, least_support: int, least_conf: float) -> DataFrame:
    """``pattern as_kind conf`` of the patterns that are confident of a kind."""
    by_kind = scored(pairs, known).groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("mass"), F.count("score").alias("support"))
    total = F.sum("n").over(Window.partitionBy("pattern"))  # at most one row a kind
    return (by_kind.withColumn("conf", F.col("mass") / (total + 0.5)).filter("kind IS NOT NULL")
            .filter((F.col("support") >= least_support) & (F.col("conf") >= least_conf)).select("pattern", F.col("kind").alias("as_kind"), "conf"))


def propose(pairs: DataFrame, conf: DataFrame, least_conf: float) -> DataFrame:
    """``value found known_score`` of the identifiers that ``conf`` finds."""
    new = pairs.filter("kind IS NULL").join(conf, "pattern").groupBy("value", "as_kind").agg(
        (1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(0.999999)))))).alias("s"))
    best = new.groupBy("value").agg(F.max(F.struct("s", (-F.col("as_kind")).alias("k"))).alias("b"))
    return best.filter(F.col("b.s") >= least_conf).select("value", (-F.col("b.k")).alias("found"), F.round("b.s", 9).alias("known_score"))


def _mark(known: DataFrame) -> tuple:
    """Tells whether the known identifiers or their scores (to four digits) changed."""
    state = F.xxhash64("value", "found", F.round("known_score", 4)).cast("decimal(38,0)")
    return tuple(known.agg(F.count(F.lit(1)), F.coalesce(F.sum(state), F.lit(0))).first())


def discover(pairs: DataFrame, rounds: int | None = None, least_support: int = 3, least_conf: float = 0.8) -> DataFrame:
    """``value kind``: identifiers that confident patterns find beside the seeds.

    ``least_support``: distinct known identifiers that a pattern must stand
    with; ``least_conf``: the least confidence of a pattern, and the least
    score of a new identifier; ``rounds``: stop after so many, else when
    nothing changes any more.
    """
    known, seen = None, (0, 0)
    for _ in range(rounds or MOST_ROUNDS):
        known = materialize(propose(pairs, confident(pairs, known, least_support, least_conf), least_conf), "personal-known")
        if seen == (seen := _mark(known)):
            break
    else:
        if rounds is None:
            raise RuntimeError(f"identifiers did not settle in {MOST_ROUNDS} rounds")
    return known.select("value", F.col("found").alias("kind"))


def _wordlike() -> Column:
    return ~F.col("value").rlike("[0-9@]")


def _judged(rows: DataFrame, found: DataFrame, conf: DataFrame, least_conf: float) -> DataFrame:
    """``found`` with the scores of word-like tokens multiplied by the share of their places that are confident slots."""
    words = materialize(found.filter(_wordlike()), "personal-words")
    if words.limit(1).count() == 0:
        return found
    at = as_places(at_values(rows, words)).join(words.select("value"), "value", "left_semi")
    # one row a value, context and task: a word of the language is not let out place by place
    by = materialize(at.groupBy("value", "before").agg(F.count(F.lit(1)).alias("n")), "personal-word-contexts")
    slot = by.select("value", "before", "n", F.explode(F.array(F.concat_ws(" ", "before"), F.concat_ws(" ", F.lit("*"), F.get("before", F.lit(1))))).alias("pattern"))
    slot = slot.join(conf.select("pattern", "as_kind"), "pattern").select("value", "before", "n", F.col("as_kind").alias("found")).distinct()
    inside = slot.groupBy("value", "found").agg(F.sum("n").alias("inside"))
    share = by.groupBy("value").agg(F.sum("n").alias("all")).join(inside, "value")
    words = words.join(share, ["value", "found"]).select("value", "found", F.round(F.col("known_score") * F.col("inside") / F.col("all"), 9).alias("known_score"))
    return found.filter(~_wordlike()).unionByName(words.filter(F.col("known_score") >= least_conf))


def bootstrap(rows: DataFrame, base: DataFrame, rounds: int | None, least_support: int, least_conf: float) -> tuple[DataFrame, DataFrame | None]:
    """Known identifiers (``value found known_score``) and the free tokens found
    on the way, which hold all their places (none: null).

    As ``discover`` over the pairs of all tokens of the corpus, of which only
    those are read that can count: the slots of patterns that may be
    confident, and the places of the identifiers that were found."""
    spark = rows.sparkSession
    pairs, spots, known = materialize(edges(base), "personal-edges"), None, None
    nothing = spark.range(0)  # made by the JVM: an empty list of rows would start Python workers that stay
    listed, located = (nothing.select(F.lit(None).cast("string").alias(c)) for c in ("pattern", "value"))
    totals = listed.withColumn("least", F.lit(None).cast("long"))

    def add(at: DataFrame) -> None:
        nonlocal pairs, spots
        both = at.unionByName(base.select(at.columns))
        free = free_tokens(both)
        spots = materialize((free if spots is None else free.unionByName(spots)).dropDuplicates(["rid", "start"]), "personal-spots")
        pairs = materialize(edges(spots.unionByName(base.select(spots.columns))), "personal-edges")

    seen = (0, 0)
    for _ in range(rounds or MOST_ROUNDS):
        ready = scored(pairs, known).filter("score IS NOT NULL").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"))
        ready = ready.filter(F.col("n") >= least_support).groupBy("pattern").agg(F.max("n").alias("n")).join(listed, "pattern", "left_anti")
        ready = materialize(ready, "personal-ready")
        new = ready.join(totals, "pattern", "left_anti").select("pattern")
        if new.limit(1).count():
            totals = materialize(totals.unionByName(least_totals(rows, new)), "personal-totals")
        may = materialize(ready.join(totals, "pattern").filter(F.col("n") >= least_conf * (F.col("least") + 0.5)).select("pattern"), "personal-may")
        if may.limit(1).count():
            add(as_places(_near(positions(rows), may)))
            listed = materialize(listed.unionByName(may), "personal-listed")
        whole = pairs.join(listed, "pattern", "left_semi")
        conf = materialize(confident(whole, known, least_support, least_conf), "personal-confident")
        known = materialize(_judged(rows, materialize(propose(whole, conf, least_conf), "personal-found"), conf, least_conf), "personal-known")
        away = materialize(known.select("value").join(located, "value", "left_anti"), "personal-away")
        new = away.limit(1).count()
        if new:
            add(as_places(at_values(rows, away)).join(away, "value", "left_semi"))
            located = materialize(located.unionByName(away), "personal-located")
        if seen == (seen := _mark(known)) and not new:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"identifiers did not settle in {MOST_ROUNDS} rounds")
    return known, spots


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None, least_support: int = 3,
         least_conf: float = 0.8) -> DataFrame:
    """Per document: ``doc_id n_email n_ip n_card n_phone base spans``; ``base``
    and ``spans`` are arrays of (kind number, start, end) in code points."""
    rows = numbered(docs, id_col, text_col)
    found = materialize(places(rows), "personal-places")
    spans = found.filter("kind IS NOT NULL")
    known, spots = bootstrap(rows, spans, rounds, least_support, least_conf)
    all_spans = spans.select("rid", "kind", "start", "end", F.lit(True).alias("is_base"))
    if spots is not None:
        added = spots.drop("kind").join(known, "value").select("rid", F.col("found").alias("kind"), "start", "end", F.lit(False).alias("is_base"))
        all_spans = all_spans.unionByName(added)
    at = F.struct(F.col("kind"), F.col("start"), F.col("end"))
    by = all_spans.groupBy("rid").agg(
        *[F.count(F.when(F.col("is_base") & (F.col("kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.when(F.col("is_base"), at))).alias("base"), F.sort_array(F.collect_list(at)).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    out = found.filter("kind IS NULL").select("rid", "doc_id").join(by, "rid", "left")
    return out.select("doc_id", *[F.coalesce(f"n_{name}", F.lit(0)).alias(f"n_{name}") for name in KINDS],
                      F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first to start covers."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    # the place reached before each span: a running maximum of the ends
    ends = F.transform(by_start, lambda s: -s["less"])
    reached = lambda i: F.coalesce(F.array_max(F.slice(ends, 1, i)), F.lit(0))
    part = lambda s, i: F.concat(F.when(s["start"] > reached(i), F.substr(text, (reached(i) + 1).cast("int"), (s["start"] - reached(i)).cast("int"))).otherwise(F.lit("")),
                                 F.when(-s["less"] > reached(i), F.get(names, s["kind"])).otherwise(F.lit("")))
    rest = F.substr(text, (F.coalesce(F.array_max(ends), F.lit(0)) + 1).cast("int"), F.length(text))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) == 0, text).otherwise(F.concat(F.array_join(F.transform(by_start, part), ""), rest))
