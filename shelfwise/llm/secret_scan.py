"""Secret scan by a trigram inverted index, in DataFrame operations only.

1. From each rule's regular expression a Boolean query over trigrams is derived:
   the trigrams that every match must contain. A rule without such trigrams
   (a class of characters alone) yields ``ANY`` and scans every text.
2. The index holds, for every trigram that a rule's query names, the documents
   whose case-folded text contains it, one row each. Postings are intersected
   by gathering, per document, the set of its trigrams (never more than the
   rules name) and evaluating each query on it.
3. Candidates are verified with the regular expression itself, on the text.

Spans are code point offsets, end exclusive, leftmost and without overlap for
each kind. Offsets come from the lengths of the pieces between the matches
(``split``) and of the matches (``regexp_extract_all``).

Defined cases: a null text counts as empty and has no span. Rows with equal or
null ids are scanned each on its own text; the index only decides which texts
are scanned.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as _c, _parser as _p
except ImportError:  # pragma: no cover
    import sre_constants as _c
    import sre_parse as _p

ANY = ("any",)
_MOST = 16  # alternatives kept apart while a query is derived


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # shortest accepted length of ``group``
    group: int = 0
    base: bool = True


#: The rules. The first three are the base; the order is the order of kinds.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, False),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, 0, False),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, 0, False),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 20, 0, False),
)


def _grams(text: str) -> tuple:
    grams = sorted({text[i: i + 3] for i in range(len(text) - 2)})
    return ("and", *[("has", g) for g in grams]) if grams else ANY


def _all(parts: list[tuple]) -> tuple:
    flat = []
    for p in parts:
        flat += list(p[1:]) if p[0] == "and" else [] if p == ANY else [p]
    flat = list(dict.fromkeys(flat))
    return ANY if not flat else flat[0] if len(flat) == 1 else ("and", *flat)


def _one(parts: list[tuple]) -> tuple:
    if any(p == ANY for p in parts):
        return ANY
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", *parts)


def trigram_query(pattern: str) -> tuple:
    """The Boolean trigram query that every text with a match fulfils, on case-folded text.

    The parsed expression is walked left to right. ``exact`` holds the strings
    the current stretch may be; when they become many, or something open
    follows, the trigrams they share with every match are noted and a new
    stretch begins.
    """
    noted: list[tuple] = []

    def walk(items) -> set[str] | None:
        """The exact strings of a sequence, or None where it is open (what is sure of it is noted)."""
        exact = {""}

        def close():
            nonlocal exact
            noted.append(_one([_grams(s) for s in exact]))
            exact = {""}

        whole = True
        for op, arg in items:
            options = None
            if op is _c.LITERAL:
                options = {chr(arg).lower()}
            elif op is _c.SUBPATTERN:
                options = sub([arg[3]])
            elif op is _c.BRANCH:
                options = sub(arg[1])
            elif op is _c.IN and all(o is _c.LITERAL for o, _ in arg):
                options = {chr(v).lower() for _, v in arg}
            elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and arg[1] != _c.MAXREPEAT and arg[1] <= 2:
                once = sub([arg[2]])
                if once is not None:
                    options = {"".join(c) for n in range(arg[0], arg[1] + 1) for c in product(sorted(once), repeat=n)}
            elif op is _c.AT:
                continue
            if options is None or len(exact) * len(options) > _MOST:
                close()
                whole = False
                exact = options if options is not None and len(options) <= _MOST else {""}
                continue
            exact = {a + b for a, b in product(exact, options)}
        if whole:
            return exact
        close()
        return None

    def sub(branches) -> set[str] | None:
        """Exact strings of alternatives; what open ones note holds only if every branch notes it."""
        nonlocal noted
        outer, noted = noted, []
        found, queries = [], []
        for b in branches:
            noted = []
            got = walk(list(b))
            found.append(got)
            queries.append(_all(noted + ([_one([_grams(s) for s in got])] if got is not None else [])))
        noted = outer
        if all(f is not None for f in found):
            return set().union(*found)
        noted.append(_one(queries))
        return None

    exact = walk(list(_p.parse(pattern)))
    if exact is not None:
        noted.append(_one([_grams(s) for s in exact]))
    return _all(noted)


def _names(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "has" else set().union(*[_names(q) for q in query[1:]]) if query != ANY else set()


def _holds(query: tuple, grams: Column) -> Column:
    if query == ANY:
        return F.lit(True)
    if query[0] == "has":
        return F.array_contains(grams, query[1])
    parts = [_holds(q, grams) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def trigram_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (trigram, id): which document's case-folded text contains which of ``trigrams``."""
    wanted = ", ".join("'" + g.replace("\\", "\\\\").replace("'", "\\'") + "'" for g in sorted(trigrams))
    return (docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("_text"))
            .select("id", F.explode(F.expr(f"filter(array({wanted}), g -> contains(_text, g))")).alias("trigram")))


def candidates(postings: DataFrame, queries: dict[str, tuple]) -> DataFrame:
    """(id, kinds): the documents that may match, by intersecting the postings of each rule's query."""
    held = postings.groupBy("id").agg(F.collect_set("trigram").alias("grams"))
    kinds = F.filter(F.array(*[F.when(_holds(q, F.col("grams")), F.lit(k)) for k, q in queries.items()]),
                     lambda k: k.isNotNull())
    return held.select("id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, spans) of every row; spans is an array of (start, kind_no, end), in that order."""
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ANY}
    if indexed:
        names = set().union(*[_names(q) for q in indexed.values()])
        found = candidates(trigram_index(plain, sorted(names), "id", "text"), indexed)
        plain = plain.join(found.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left") \
            .select("id", "text", "kinds")
    else:
        plain = plain.withColumn("kinds", F.lit(None).cast("array<string>"))
    empty = "cast(array() as array<struct<p: int, m: int, ok: boolean>>)"
    parts = []
    for i, r in enumerate(rules):
        p = r.pattern.replace("\\", "\\\\").replace("'", "\\'")
        # lengths of the piece before each match and of the match, and whether the match counts
        pieces = (f"zip_with(regexp_extract_all(text, '{p}', 0), split(text, '{p}', -1), (m, p) ->"
                  f" named_struct('p', length(p), 'm', length(m), 'ok', coalesce(length(m) >= {r.least}, false)))")
        if r.group:
            pieces = (f"zip_with({pieces}, regexp_extract_all(text, '{p}', {r.group}), (x, g) ->"
                      f" named_struct('p', x.p, 'm', x.m, 'ok', coalesce(length(g) >= {r.least}, false)))")
        scan = "true" if queries[r.kind] == ANY else f"array_contains(kinds, '{r.kind}')"
        plain = plain.withColumn(f"_l{i}", F.expr(f"if({scan}, if(text rlike '{p}', {pieces}, {empty}), {empty})"))
        parts.append(f"""aggregate(_l{i},
            named_struct('at', 0, 'out', cast(array() as array<struct<start: int, kind: int, end: int>>)),
            (s, x) -> named_struct('at', s.at + x.p + coalesce(x.m, 0), 'out',
                if(x.ok, array_append(s.out, named_struct('start', s.at + x.p, 'kind', {i}, 'end', s.at + x.p + x.m)),
                   s.out)), s -> s.out)""")
    return plain.select("id", F.expr(f"array_sort(concat({', '.join(parts)}))").alias("spans"))


def joined(spans: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the array column ``spans``, comma-joined."""
    kinds = ", ".join(f"'{r.kind}'" for r in rules)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', get(array({kinds}), x.kind), x.start, x.end)), ',')")
