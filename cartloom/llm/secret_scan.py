"""Secret scan over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: every match must contain, for each
required part, all trigrams of one of the part's alternatives. The index lists, for each trigram that some rule needs, the
documents that contain it. Intersecting the lists gives each rule's candidates, on which alone its expression
is run; rules whose expression requires no trigram are run on all documents. Everything is DataFrame functions.

Spans come from cutting a text at the matches: what lies between and the matches' lengths add up to their places.

Defined cases: a null text is empty and has no spans; null ``doc_id`` are matched like any other; rows that share a ``doc_id``
share candidates, which only adds scans; results count code points and end exclusively; documents of any length are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.shared import stored

# Alternatives of a required part beyond which it says too little to be worth looking up.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and how long the whole match or one of its groups must be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False
    # An expression with the same matches but those that are too short, if there is one.
    long_pattern: str | None = None

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + (self.long_pattern or self.pattern)


# The base rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        any_case=True,
    ),
    # Both match up to the end of a run of their characters, so asking for more of them skips only short runs.
    Rule("access", r"AKIA[A-Z0-9]+", least=18, long_pattern=r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]+", least=16, long_pattern=r"[0-9a-f]{16,}"),
)
# Whatever may start anywhere in a long run of its own characters has a bound, so that no text takes more than linear time:
# schemes have up to 31 characters (the match starts so far before ://), the first part of a token up to 515, key kinds four words.
ADDED_RULES = (
    Rule("session", r"ASIA[A-Z0-9]{16}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,512}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]{20,}", any_case=True),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,30}://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE_RULES + ADDED_RULES


def trigram_query(rule: Rule) -> list[list[list[str]]]:
    """What every match contains: all parts of the list, of each one alternative, of that all trigrams, in lower case.

    The index is over lower-cased texts; that serves rules of any case and loses nothing for others. An empty
    list means that the rule requires no trigram.
    """

    def strings(items) -> tuple[set[str] | None, list[set[str]]]:
        """All texts that ``items`` can match, if they are few, and the parts they require otherwise."""
        texts: set[str] | None = {""}
        parts: list[set[str]] = []
        run = {""}  # the texts of the items since the last that was open

        def shut() -> None:
            nonlocal run
            parts.append(run)
            run = {""}

        for op, value in items:
            own: set[str] | None
            inner: list[set[str]] = []
            if op is sre.LITERAL:
                own = {chr(value)}
            elif op is sre.SUBPATTERN:
                own, inner = strings(value[-1])
            elif op is sre.BRANCH:
                each = [strings(branch)[0] for branch in value[1]]
                own = None if None in each else set().union(*each)
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in value):
                own = {chr(v) for _, v in value}
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 1:
                own, inner = strings(value[2])
                own = None if own is None else own | ({""} if value[0] == 0 else set())
                inner = inner if value[0] else []
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                own, inner = None, strings(value[2])[1] if value[0] else []
            else:
                own = None
            if own is not None and len(run) * len(own) > MOST_ALTERNATIVES:
                shut()
            if own is None:
                texts = None
                shut()
                parts.extend(inner)
            else:
                run = {a + b for a in run for b in own}
                texts = None if texts is None or len(texts) * len(own) > MOST_ALTERNATIVES else {a + b for a in texts for b in own}
        shut()
        return texts, parts

    required = strings(sre_parser.parse(rule.pattern))[1]
    query = []
    for part in required:
        if all(len(text) >= 3 for text in part):
            alternatives = {tuple(sorted({t[i : i + 3] for i in range(len(t) - 2)})) for t in map(str.lower, part)}
            # One that asks for more than another adds nothing.
            least = [a for a in alternatives if not any(set(b) < set(a) for b in alternatives)]
            query.append([list(a) for a in sorted(least)])
    return query


def needed_trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({g for r in rules for part in trigram_query(r) for alternative in part for g in alternative})


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The postings (trigram, doc_id) of ``docs`` (doc_id, text) for the trigrams that are looked up."""
    lowered = docs.select("doc_id", F.lower("text").alias("_text"))
    found = F.array_compact(F.array(*[F.when(F.contains("_text", F.lit(g)), F.lit(g)) for g in trigrams]))
    return lowered.select("doc_id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): by intersecting the postings, the rules that may match in a document."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r))}
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))

    def holds(query: list[list[list[str]]]) -> Column:
        parts = []
        for part in query:
            each = [
                reduce(Column.__and__, [F.array_contains("held", g) for g in alternative]) for alternative in part
            ]
            parts.append(reduce(Column.__or__, each))
        return reduce(Column.__and__, parts)

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind)) for kind, q in queries.items()]))
    return held.select("doc_id", kinds.alias("kinds")).filter(F.size("kinds") > 0)


# In this order of fields they sort by start, then by the order of the rules.
SPAN = "array<struct<start:int,priority:int,end:int,kind:string>>"


def spans_of(rule: Rule, priority: int, text: Column) -> Column:
    """The matches of a rule in ``text`` with their places."""
    matches = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)) if rule.group else matches
    between = F.transform(F.split(text, rule.java, -1), F.length)
    lengths = F.transform(matches, F.length)
    # A match starts after all texts between and all matches before it.
    steps = F.arrays_zip(between.alias("gap"), lengths.alias("size"), F.transform(groups, F.length).alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.coalesce(x["size"], F.lit(0))
        span = F.struct(
            begin.alias("start"), F.lit(priority).alias("priority"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = x["size"].isNotNull() & (x["part"] >= rule.least)
        grown = F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), grown.cast(SPAN).alias("spans"))

    places = F.aggregate(steps, start, step, lambda state: state["spans"])
    return F.when(F.size(matches) > 0, places).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with secret_spans: all matches of all rules, by start, then in the order of the rules.

    A column of that name is replaced.
    """
    docs = docs.drop("secret_spans")
    indexed = {r.kind for r in rules if trigram_query(r)}
    kept = candidates(trigram_index(docs, needed_trigrams(rules)), rules)
    kept = stored(kept, "secret-candidates").select(F.col("doc_id").alias("_id"), F.col("kinds").alias("_kinds"))
    text = F.coalesce(docs["text"], F.lit(""))
    found = []
    for priority, rule in enumerate(rules):
        spans = spans_of(rule, priority, text)
        if rule.kind in indexed:
            spans = F.when(F.array_contains(kept["_kinds"], rule.kind), spans).otherwise(F.array().cast(SPAN))
        found.append(spans)
    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.array_sort(F.concat(*found)).alias("secret_spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    text = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], gap, F.lit(mark))).alias("out"),
        )

    rest = F.aggregate(
        spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)
