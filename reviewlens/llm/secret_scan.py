"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From its syntax tree a Boolean query over trigrams is derived that every match
satisfies. The index has, for each trigram that some query asks for, the documents whose lower-cased text holds
it; postings are intersected and united as the queries say, and the rule runs on the candidates alone.
A rule with no mandatory trigram runs on every document. Candidates are always verified by the expression, so
the index only saves work.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from re import _constants as _c
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stored

#: Strings that a part of an expression may stand for are listed up to this many; beyond it they are unknown.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``group`` is what must have ``least`` characters (0: the match itself); shorter matches are dropped.

    ``fold`` takes the letters of the expression in either case.
    """

    kind: str
    expression: str
    group: int = 0
    least: int = 0
    fold: bool = False


@dataclass(frozen=True)
class Query:
    """All of ``trigrams`` and, for each group of alternatives, one of them. An empty query asks for nothing."""

    trigrams: frozenset[str] = frozenset()
    choices: tuple[tuple[Query, ...], ...] = field(default=())

    def __bool__(self) -> bool:
        return bool(self.trigrams or self.choices)

    def both(self, other: Query) -> Query:
        return Query(self.trigrams | other.trigrams, self.choices + other.choices)

    def all_trigrams(self) -> set[str]:
        return set(self.trigrams).union(*(q.all_trigrams() for options in self.choices for q in options))

    def holds(self, has) -> Column | None:
        """The query as a condition; ``has`` gives the condition of one trigram."""
        parts = [has(t) for t in sorted(self.trigrams)]
        parts += [reduce(Column.__or__, (q.holds(has) for q in options)) for options in self.choices]
        return reduce(Column.__and__, parts) if parts else None


def any_of(options: list[Query]) -> Query:
    """One of the queries holds; nothing is asked if one of them asks for nothing."""
    unique = list(dict.fromkeys(options))
    if not all(unique):
        return Query()
    plain = [q.trigrams for q in unique if not q.choices]
    unique = [q for q in unique if not any(p < q.trigrams for p in plain)]  # another option asks for less
    return unique[0] if len(unique) == 1 else Query(choices=(tuple(unique),))


def trigrams_of(strings: set[str]) -> Query:
    """What a text that holds one of the strings must hold."""
    return any_of([Query(frozenset(s[i : i + 3] for i in range(len(s) - 2))) for s in sorted(strings)])


def trigram_query(expression: str) -> Query:
    """The Boolean trigram query of an expression, over lower-cased text."""
    strings, query = _sequence(_parser.parse(expression))
    return query.both(trigrams_of(strings)) if strings is not None else query


def _sequence(items) -> tuple[set[str] | None, Query]:
    """(the lower-cased strings that the items may match, if few; what else a match must hold)."""
    whole, run, query = True, {""}, Query()
    for item in items:
        strings, more = _item(*item)
        query = query.both(more)
        if strings is None or len(run) * len(strings) > MOST_STRINGS:
            query = query.both(trigrams_of(run))
            whole, run = False, strings if strings is not None else {""}
        else:
            run = {a + b for a, b in product(run, strings)}
    if whole:
        return run, query
    return None, query.both(trigrams_of(run))


def _item(op, value) -> tuple[set[str] | None, Query]:
    if op is _c.LITERAL:
        return {chr(value).lower()}, Query()
    if op is _c.IN:
        return _characters(value), Query()
    if op is _c.SUBPATTERN:
        return _sequence(value[-1])
    if op is _c.BRANCH:
        found = [_sequence(option) for option in value[1]]
        if all(strings is not None for strings, _ in found):
            union = set().union(*(strings for strings, _ in found))
            if len(union) <= MOST_STRINGS:
                return union, any_of([q for _, q in found])
        return None, any_of([q.both(trigrams_of(s)) if s is not None else q for s, q in found])
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT):
        low, high, inner = value
        strings, query = _sequence(inner)
        if low == 0:
            return ({""} | strings if high == 1 and strings is not None else None), Query()
        if strings is not None and low == high == 1:
            return strings, query
        if strings is not None and len(strings) ** min(low, 8) <= MOST_STRINGS:
            query = query.both(trigrams_of({"".join(p) for p in product(strings, repeat=min(low, 8))}))
        return None, query
    if op is _c.AT:
        return {""}, Query()
    return None, Query()


def _characters(members) -> set[str] | None:
    found: set[str] = set()
    for op, value in members:
        if op is _c.LITERAL:
            found.add(chr(value).lower())
        elif op is _c.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


#: The base kinds in their order, then the formats that the method adds.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        fold=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login", r"[a-z]{2,16}://[A-Za-z0-9._~%+-]{1,64}:[A-Za-z0-9._~%+!$*-]{3,64}@[A-Za-z0-9.-]+"),
)
RULES = BASE + ADDED


def java(rule: Rule) -> str:
    """The expression as Spark runs it; only its ASCII letters fold."""
    if not rule.fold:
        return rule.expression
    head, separator, tail = rule.expression.partition(")")
    return f"(?i){head})(?-i){tail}" if separator else f"(?i){rule.expression}"


def _folded(items: Column, empty: Column, grow: Callable[[Column, Column, Column], Column], near: Callable[[Column, Column], Column]) -> Column:
    """struct<at, out> of a fold over ``items`` that appends to ``out``.

    Appending copies what is there, so items are folded ``CHUNK`` at a time, and the chunks' outputs appended then:
    thousands of matches in one text cost thousands of small copies, not of large ones. ``grow`` also gets what
    ``near`` makes once of a chunk and the place where it begins, with that place as ``at``.
    """
    none = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def fold(every: Column) -> Column:
        count = F.floor((F.size(every) - 1) / F.lit(CHUNK)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count), lambda i: F.slice(every, i * CHUNK + 1, CHUNK))

        def add(held: Column, chunk: Column) -> Column:
            def own(base: Column) -> Column:
                return F.aggregate(
                    chunk,
                    F.struct(held["at"].alias("at"), empty.alias("out")),
                    lambda so_far, item: grow(so_far, item, base),
                    lambda done: F.struct(done["at"].alias("at"), F.concat(held["out"], done["out"]).alias("out")),
                )

            return F.transform(F.array(F.struct(held["at"].alias("at"), near(held["at"], chunk).alias("near"))), own)[0]

        return F.when(F.size(every) > 0, F.aggregate(chunks, none, add)).otherwise(none)

    # An array of one makes of an expression a value that is there, and is not evaluated anew wherever it is used.
    return F.transform(F.array(items), fold)[0]


def _free(name: str, taken: list[str]) -> str:
    """``name``, longer if a column is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, end, kind_order, kind>> of a rule's matches, in code points, end exclusive.

    Spark gives the matches and the text between them, not their positions; these are the running sums of lengths.
    """
    expression = F.lit(java(rule))
    found = F.regexp_extract_all(text, expression, F.lit(0))
    sized = F.regexp_extract_all(text, expression, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, java(rule), -1)
    steps = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
        sized,
        lambda a, s: F.struct(a["gap"].alias("gap"), a["size"].alias("size"), F.length(s).alias("measure")),
    )
    kind = "array<struct<start:int,end:int,ord:int,kind:string,measure:int>>"

    def grow(held: Column, step: Column, _: Column) -> Column:
        begin = held["at"] + step["gap"]
        one = F.struct(
            begin.alias("start"),
            (begin + step["size"]).alias("end"),
            F.lit(order).alias("ord"),
            F.lit(rule.kind).alias("kind"),
            step["measure"].alias("measure"),
        )
        return F.struct((begin + step["size"]).alias("at"), F.concat(held["out"], F.array(one).cast(kind)).alias("out"))

    every = _folded(steps, F.array().cast(kind), grow, lambda at, chunk: F.lit(None).cast("string"))["out"]
    return F.transform(
        F.filter(every, lambda s: s["measure"] >= rule.least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["ord"].alias("ord"), s["kind"].alias("kind")),
    )


#: Matches of a text that are put together at a time.
CHUNK = 64
SPAN = "array<struct<start:int,end:int,ord:int,kind:string>>"


def _index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(doc_id, trigram): the postings of the trigrams that some query asks for."""
    lower = F.lower(F.col("text"))
    held = F.filter(F.array(*[F.when(F.contains(lower, F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(held).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, dict[str, str]]:
    """(doc_id, one flag per indexed rule), and the flag of each rule that has mandatory trigrams.

    A doc_id is a candidate of a rule if its rows together satisfy the query.
    """
    queries = {r.kind: trigram_query(r.expression) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q}
    trigrams = sorted(set().union(*(q.all_trigrams() for q in indexed.values())))
    flags = {kind: f"may_{kind}" for kind in indexed}
    postings = _index(docs, trigrams)
    lists = postings.groupBy("doc_id").agg(
        *[F.bool_or(F.col("trigram") == t).alias(f"t{i}") for i, t in enumerate(trigrams)]
    )
    number = {t: i for i, t in enumerate(trigrams)}
    found = lists.select(
        "doc_id", *[q.holds(lambda t: F.col(f"t{number[t]}")).alias(flags[kind]) for kind, q in indexed.items()]
    )
    return found.where(reduce(Column.__or__, map(F.col, flags.values()))), flags


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "__secrets") -> DataFrame:
    """``docs`` with an array of spans, by start and then by the order of the rules.

    Null and empty texts have none. Rows that repeat a doc_id share their candidate flags, which only means
    that a rule may run in vain; rows without a doc_id share theirs too. Other columns stay as they are, whatever
    they are called; only ``name`` itself must not be among them.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {name} already")
    found, flags = candidates(docs, rules)
    marks = {kind: _free(f"__{flag}", docs.columns) for kind, flag in flags.items()}
    key = _free("__doc", docs.columns)
    index = stored(found.select(F.col("doc_id").alias(key), *[F.col(flags[k]).alias(marks[k]) for k in flags]), "candidates")
    joined = docs.join(index, docs["doc_id"].cast("long").eqNullSafe(index[key]), "left")
    text = F.coalesce(docs["text"], F.lit(""))
    parts = [
        F.when(F.col(marks[r.kind]), spans(text, r, i)).otherwise(F.array().cast(SPAN))
        if r.kind in marks
        else F.when(text.rlike(java(r)), spans(text, r, i)).otherwise(F.array().cast(SPAN))
        for i, r in enumerate(rules)
    ]
    ordered = F.array_sort(F.flatten(F.array(*parts)), _by_start)
    return joined.withColumn(name, ordered).drop(key, *marks.values())


def _by_start(a: Column, b: Column) -> Column:
    return (
        F.when(a["start"] < b["start"], -1)
        .when(a["start"] > b["start"], 1)
        .otherwise(F.signum(a["ord"].cast("double") - b["ord"]).cast("int"))
    )


def written(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, one count per base kind, base_sha256, spans) of each row.

    Letters fold as in ASCII. A null or empty text has no spans; repeated rows are scanned one by one, a null
    doc_id stays null, other columns are not read, and an empty table gives no rows.
    """
    found, base = F.col("__secrets"), {r.kind for r in BASE}
    scanned = with_spans(docs.select("doc_id", "text"), rules).select(F.col("doc_id").cast("long").alias("doc_id"), "__secrets")
    of_kind = lambda kind: F.filter(found, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    of_base = F.filter(found, lambda s: s["kind"].isin(*base))
    return scanned.select("doc_id", *counts, F.sha2(written(of_base), 256).alias("base_sha256"), written(found).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by ``[kind]``; overlapping spans become one, named by the first.

    Columns stay as they are, except that ``n_chars``, if there, is the length of the new text.
    """
    name = _free("__secrets", docs.columns)
    scanned = with_spans(docs, rules, name)
    text, found = F.col("text"), F.col(name)

    def near(at: Column, chunk: Column) -> Column:
        """The text from ``at`` to the last end in the chunk: places within it are found without reading all before."""
        return F.substring(text, at + 1, F.greatest(F.array_max(F.transform(chunk, lambda s: s["end"])) - at, F.lit(0)))

    def grow(held: Column, s: Column, base: Column) -> Column:
        between = F.substring(base["near"], held["at"] - base["at"] + 1, s["start"] - held["at"])
        return (
            F.when(s["end"] <= held["at"], held)
            .when(s["start"] < held["at"], F.struct(s["end"].alias("at"), held["out"].alias("out")))
            .otherwise(
                F.struct(s["end"].alias("at"), F.concat(held["out"], between, F.lit("["), s["kind"], F.lit("]")).alias("out"))
            )
        )

    redacted = F.transform(
        F.array(_folded(found, F.lit(""), grow, near)), lambda held: F.concat(held["out"], F.substring(text, held["at"] + 1, F.length(text)))
    )
    clean = F.when(F.size(found) > 0, redacted[0]).otherwise(text)
    changed = scanned.withColumn("text", clean)
    if "n_chars" in docs.columns:
        n = F.when(F.size(name) > 0, F.length("text")).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
