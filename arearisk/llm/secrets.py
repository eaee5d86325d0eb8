"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. A Boolean trigram query is derived from it: what
every match must hold, as conjunctions and alternatives of trigrams. The index is a table of postings, (trigram, document key), for the
trigrams that the rules ask for, over lower-cased text. Intersecting the
postings of a conjunction gives its candidates, and only those are searched with
the expression; a rule without mandatory trigrams scans every text.

A text with matches is cut at them once; where they lie are running lengths of its
parts, as rows of a window, so the work is linear in the matches.

A key is a 64-bit hash of id and text. Two documents that share one by accident
become candidates together, which costs a search and loses nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants, _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arearisk.llm.common import quoted
from arearisk.scratch import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    `least` is the length that group `group` of a match must have (group 0: the match); others are dropped.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base kinds, in the order that breaks ties of spans.
BASE = (
    Rule("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

#: Further kinds with a form of their own.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

RULES = BASE + MORE

#: Marks the ends of matches; no rule can match it, so in a text it is replaced first.
_MARK, _OTHER = "\ue000", "\ue001"


#: While strings that must occur are gathered: the most letters of a class and the most strings at a time.
MOST_LETTERS, MOST_STRINGS = 8, 64

#: A trigram query: every trigram and every part must hold (`ALL`), or one of the parts must (`ONE`). No part: always true.
ALL, ONE = "all", "one"


def trigrams(literal: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(literal[i:i + 3] for i in range(len(literal) - 2)))


def trigram_query(rule: Rule) -> tuple | None:
    """What any match of the rule holds in lower case, as a nested (ALL or ONE, parts) of trigrams; None: nothing follows."""
    try:
        parsed = _parser.parse(rule.pattern)
    except re.error:
        return None  # An expression only Java knows.
    ends, query, _ = _required(parsed)
    return _both(query, _one_of(ends))


def _both(*queries: tuple | None) -> tuple | None:
    parts = tuple(dict.fromkeys(q for q in queries if q is not None))
    return (ALL, parts) if len(parts) > 1 else parts[0] if parts else None


def _one_of(strings: set[str] | None) -> tuple | None:
    """Query for one of some strings; one with fewer than three characters asks for nothing."""
    found = {frozenset(trigrams(x)) for x in strings or {""}}
    if frozenset() in found:
        return None
    # An alternative that asks for more than another one adds nothing.
    found = [o for o in found if not any(other < o for other in found)]
    options = tuple((ALL, tuple(sorted(o))) for o in sorted(found, key=sorted))
    return (ONE, options) if len(options) > 1 else options[0]


def _required(items) -> tuple[set[str] | None, tuple | None, bool]:
    """For a sequence of parsed items: the strings one of which its end is (None: its end says nothing), a query for what
    comes before, and whether nothing does, so that the strings are all that the sequence can match.
    """
    ends, query, whole = {""}, None, True
    for kind, value in items:
        exact, own = _strings(kind, value)
        if exact is not None and ends is not None and len(ends) * len(exact) <= MOST_STRINGS:
            ends = {a + b for a in ends for b in exact}
            continue
        query = _both(query, _one_of(ends), own)
        ends, whole = exact, False
    return ends, query, whole


def _strings(kind, value) -> tuple[set[str] | None, tuple | None]:
    """All strings of an item in lower case if they are few, else None and a query for it."""
    if kind is _constants.LITERAL:
        return {chr(value).lower()}, None
    if kind is _constants.AT:
        return {""}, None
    if kind is _constants.IN:
        letters: set[str] = set()
        for sort, v in value:
            if sort is _constants.LITERAL:
                letters.add(chr(v).lower())
            elif sort is _constants.RANGE and v[1] - v[0] < 4 * MOST_LETTERS:
                letters |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, None
        return (letters, None) if len(letters) <= MOST_LETTERS else (None, None)
    if kind is _constants.SUBPATTERN:
        return _whole(value[-1])
    if kind is _constants.BRANCH:
        found = [_whole(b) for b in value[1]]
        if all(exact is not None for exact, _ in found):
            return set().union(*(exact for exact, _ in found)), None
        queries = [own if exact is None else _one_of(exact) for exact, own in found]
        return None, None if None in queries else (ONE, tuple(queries))
    if kind in (_constants.MAX_REPEAT, _constants.MIN_REPEAT, _constants.POSSESSIVE_REPEAT):
        least, most, inner = value
        exact, own = _whole(inner)
        if exact is not None and most != _constants.MAXREPEAT and len(exact) ** most <= MOST_STRINGS and most <= MOST_STRINGS:
            out, times = set(), {""}
            for n in range(most + 1):
                out |= times if n >= least else set()
                times = {a + b for a in times for b in exact}
            return out, None
        if not least:
            return None, None
        if exact is not None and len(exact) == 1 and least <= MOST_STRINGS:
            return None, _one_of({next(iter(exact)) * least})
        return None, own if exact is None else _one_of(exact)
    return None, None


def _whole(items) -> tuple[set[str] | None, tuple | None]:
    """Strings of a sequence if it has no others, else None and its query."""
    ends, query, whole = _required(items)
    return (ends, None) if whole else (None, _both(query, _one_of(ends)))


def asked(query: tuple | None) -> set[str]:
    """All trigrams of a query."""
    return {t for part in query[1] for t in ({part} if isinstance(part, str) else asked(part))} if query else set()


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `text` (NULL as empty), whether it was `missing`, `key` and `rest`, a struct of the other columns."""
    rest = [quoted(c) for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"),
                       quoted(text_col).isNull().alias("missing"), (F.struct(*rest) if rest else F.lit(None).cast("int")).alias("rest"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def postings(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: one row per trigram that some rule asks for and document key that has it."""
    wanted = sorted({t for r in rules for t in asked(trigram_query(r))})
    if not wanted:
        return rows.select(F.lit("").alias("trigram"), "key").limit(0)
    held = [F.when(F.contains(F.col("lower"), F.lit(t)), F.lit(t)) for t in wanted]
    lower = rows.select("key", F.lower("text").alias("lower"))
    return lower.select("key", F.explode(F.array_compact(F.array(*held))).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`key` and, per rule with a trigram query, whether the postings fulfil it there."""
    queries = {r.kind: trigram_query(r) for r in rules}
    wanted = sorted({t for q in queries.values() for t in asked(q)})
    number = {t: i for i, t in enumerate(wanted)}
    words = [F.bit_or(_bit(wanted[w:w + 62])).alias(f"w{w // 62}") for w in range(0, len(wanted), 62)]
    seen = index.groupBy("key").agg(*words) if words else index.select("key").distinct()

    def holds(query: tuple) -> Column:
        kind, parts = query
        masks: dict[int, int] = {}
        for t in (p for p in parts if isinstance(p, str)):
            masks[number[t] // 62] = masks.get(number[t] // 62, 0) | 1 << number[t] % 62
        own = [F.col(f"w{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in sorted(masks.items())]
        own += [holds(p) for p in parts if not isinstance(p, str)]
        return reduce((lambda a, b: a & b) if kind == ALL else (lambda a, b: a | b), own)

    flags = [holds(q).alias(f"may_{kind}") for kind, q in queries.items() if q]
    found = seen.select("key", *flags)
    return found.filter(reduce(lambda a, b: a | b, [F.col(f"may_{k}") for k, q in queries.items() if q])) if flags else found.limit(0)


def _bit(part: list[str]) -> Column:
    """A bit of its own for every trigram of a word of up to 62."""
    out = F.when(F.col("trigram") == part[0], F.lit(1).cast("long"))
    for i, t in enumerate(part[1:], 1):
        out = out.when(F.col("trigram") == t, F.lit(1 << i).cast("long"))
    return out.otherwise(F.lit(0).cast("long"))


def part_lengths(text: Column, rule: Rule) -> Column:
    """Lengths in code points of the parts of a text that marks around every match of a rule cut out.

    Parts: text, match, text, match ... With a group: text, match, (its group, an empty part), text, match ...
    """
    framed = f"{_MARK}${rule.group}{_MARK}" if rule.group else ""
    marked = F.regexp_replace(F.translate(text, _MARK, _OTHER), F.lit(rule.pattern), F.lit(f"{_MARK}$0{framed}{_MARK}"))
    return F.transform(F.split(marked, _MARK), lambda p: F.length(p))


def spans_of(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Matches of distinct (key, other, text) rows with a column able_<kind> per rule, in one row per key.

    `found`: (other, spans, cuts, stop). `spans` are (start, place, end) by start; `cuts` the stretches (begin, end,
    place) of text before each span that does not overlap an earlier one; `stop` is where the last span ends.
    """
    cut = F.array_compact(F.array(*[
        F.when(F.col(f"able_{r.kind}"), F.struct(F.lit(p).alias("place"), part_lengths(F.col("text"), r).alias("lengths")))
        for p, r in enumerate(rules)]))
    parts = texts.select("key", "other", F.explode(cut).alias("c")).select(
        "key", "other", F.col("c.place").alias("place"), F.posexplode("c.lengths").alias("pos", "n"))
    grouped = F.col("place").isin([p for p, r in enumerate(rules) if r.group])
    at = F.col("pos") % F.when(grouped, 4).otherwise(2)
    least = reduce(lambda w, p: w.when(F.col("place") == p, rules[p].least), range(1, len(rules)), F.when(F.col("place") == 0, rules[0].least))
    order = Window.partitionBy("key", "other", "place").orderBy("pos")
    before = F.coalesce(F.sum(F.when(at < 2, F.col("n")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    matches = parts.select("key", "other", "place", before.cast("int").alias("start"), at.alias("at"), "n",
                           F.when(grouped, F.lead("n").over(order)).otherwise(F.col("n")).alias("measured"))
    matches = matches.filter((F.col("at") == 1) & (F.col("measured") >= least)).withColumn("end", F.col("start") + F.col("n"))
    earlier = Window.partitionBy("key", "other").orderBy("start", "place", "end").rowsBetween(Window.unboundedPreceding, -1)
    matches = matches.withColumn("covered", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    fresh = F.when(F.col("start") >= F.col("covered"), F.struct(F.col("covered").alias("begin"), F.col("start").alias("end"), "place"))
    each = matches.groupBy("key", "other").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "end"))).alias("spans"),
        F.array_sort(F.collect_list(fresh)).alias("cuts"), F.max("end").alias("stop"))
    return each.groupBy("key").agg(F.collect_list(F.struct("other", "spans", "cuts", "stop")).alias("found"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `text`, `rest` (the other columns) and `spans`, an array of (start, place, end) by start, then by the rule's place in `rules`.

    Also `missing` and what `redact` needs: `cuts` and `stop`. A NULL or empty text has no spans; equal rows have equal
    spans and are searched once; NULL ids are scanned like any other; an empty table gives an empty result. Other columns
    stay inside `rest`, so their names cannot clash.
    """
    rows = keyed(docs, id_col, text_col)
    held = materialize(candidates(materialize(postings(rows, rules), "postings"), rules), "candidates")
    # A second hash tells texts with equal keys apart.
    rows = rows.withColumn("other", F.xxhash64(F.lit("other"), "text"))
    # The candidates are stored, so the planner knows their size: while they are few, texts need not move to be searched.
    checked = rows.join(held.withColumnRenamed("key", "c_key"), F.col("key") == F.col("c_key"), "left")
    able = []
    for rule in rules:
        may = F.col("text").rlike(rule.pattern)
        if f"may_{rule.kind}" in held.columns:
            may = F.coalesce(F.col(f"may_{rule.kind}"), F.lit(False)) & may
        able.append(may.alias(f"able_{rule.kind}"))
    hits = checked.select("key", "other", "text", *able).filter(reduce(lambda a, b: a | b, [F.col(f"able_{r.kind}") for r in rules]))
    found = spans_of(hits.dropDuplicates(["key", "other"]), rules)
    # Texts are shuffled by key at every size, so that a small set of matches does not change the plan.
    both = rows.join(found.withColumnRenamed("key", "f_key").hint("merge"), F.col("key") == F.col("f_key"), "left")
    own = F.get(F.filter("found", lambda f: f["other"] == F.col("other")), F.lit(0))
    both = both.select("doc_id", "text", "missing", "rest", own.alias("own"))
    return both.select(
        "doc_id", "text", "missing", "rest", F.coalesce("own.spans", F.array().cast("array<struct<start:int,place:int,end:int>>")).alias("spans"),
        F.coalesce("own.cuts", F.array().cast("array<struct<begin:int,end:int,place:int>>")).alias("cuts"), F.coalesce("own.stop", F.lit(0)).alias("stop"))


def is_rule(place: int):
    """Condition on a span: it comes from the rule at `place`."""
    return lambda s: s["place"] == place


def named_spans(spans: Column, rules: tuple[Rule, ...] = RULES, first: int | None = None) -> Column:
    """Spans as kind:start:end joined by commas; with `first` only those of the first rules."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    kept = F.filter(spans, lambda s: s["place"] < first) if first is not None else spans
    text = F.transform(kept, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


#: Redaction takes pieces out of blocks of so many code points, made from larger ones, as a piece far into a long text costs its place.
_BLOCK, _LARGE = 1 << 11, 1 << 16


def _blocks(text: Column, size: int) -> Column:
    places = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int"))
    return F.when(F.length(text) > 0, F.transform(places, lambda i: F.substring(text, i * size + 1, F.lit(size)))).otherwise(F.array(F.lit("")))


def _piece(blocks: Column, begin: Column, end: Column) -> Column:
    """Code points `begin` to `end` of a text given in blocks."""
    def part(i: Column) -> Column:
        first = F.greatest(begin - i * _BLOCK, F.lit(0))
        return F.substring(F.get(blocks, i), first + 1, F.least(end - i * _BLOCK, F.lit(_BLOCK)) - first)

    held = F.sequence(F.floor(begin / _BLOCK).cast("int"), F.floor((end - 1) / _BLOCK).cast("int"))
    return F.when(end > begin, F.array_join(F.transform(held, part), "")).otherwise("")


def redacted(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of `scan` with `clean`, the text with every span replaced by [kind]; overlapping spans become one, named by the first."""
    found = F.size("spans") > 0
    blocks = F.when(found, F.flatten(F.transform(_blocks(F.col("text"), _LARGE), lambda t: _blocks(t, _BLOCK)))) \
        .otherwise(F.array().cast("array<string>"))
    # A generated column is computed once per row; a projected one would be put into the lambdas below and run for each span.
    rows = rows.select("*", F.explode(F.array(blocks)).alias("blocks"))
    names = F.array(*[F.lit(r.kind) for r in rules])
    pieces = F.transform("cuts", lambda c: F.concat(_piece(F.col("blocks"), c["begin"], c["end"]), F.lit("["), F.get(names, c["place"]), F.lit("]")))
    tail = _piece(F.col("blocks"), F.col("stop"), F.length("text"))
    return rows.withColumn("clean", F.when(found, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col("text")))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars") -> DataFrame:
    """The rows of `docs` with every secret replaced by its kind in brackets; a length column is brought up to date.

    A text without spans stays as it is, a NULL one NULL; equal rows stay as many; NULL ids are kept; an empty table
    gives an empty one; other columns pass through whatever their names.
    """
    done = redacted(scan(docs, rules, id_col, text_col), rules)
    found = F.size("spans") > 0
    out = []
    for c in docs.columns:
        if c == id_col:
            out.append(F.col("doc_id").alias(c))
        elif c == text_col:
            out.append(F.when(~F.col("missing"), F.col("clean")).alias(c))
        elif c == length_col:
            out.append(F.when(found, F.length("clean")).otherwise(F.col("rest").getField(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("rest").getField(c).alias(c))
    return done.select(*out)
