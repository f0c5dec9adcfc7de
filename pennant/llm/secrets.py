"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong findings are regular-expression matches. Weak parts (an access
identifier, a secret, an endpoint) prove nothing alone; a part is reported only
when a part of another role lies in the same scope, at most `reach` code points
away. Scopes are the paragraphs of a text, divided by blank lines.

Every text is one row and stays one row: matches become one array of spans in
order of start, so there is no shuffle, and no group that could grow hot. The
interval join is a sweep over that array, once forward and once backward, which
carries the end of the last part (the start of the next) of each role in the
scope. It asks only whether a partner exists; no pairs are made. Sweeps go by
blocks of BLOCK spans whose states are then merged: array functions copy a state
with each step, so it must not hold what was found so far, and for n spans this
takes n*BLOCK/2 + (n/BLOCK)**2/2 steps in place of n*n.

Null and empty texts have no findings, an empty table has no rows. Repeated rows
each get their own result. A very long text is scanned whole. No column of docs
but id and text is read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strong kinds in the order in which spans with one start are listed: name,
#: pattern, the group whose length counts, least length, and substrings of the
#: lower-cased text of which any match has at least one.
STRONG = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, ("passw", "secret", "token", "api")),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16, ("akia",)),
    ("hex", r"[0-9a-f]{32,}", 0, 32, ()),
)
#: Weak parts: name, role, pattern, substrings. They follow the strong kinds in the order.
WEAK = (
    ("ident", "access", r"(?<![A-Za-z0-9])(?i:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.@-]{3,}", ("user", "login", "account", "clientid", "client_id", "keyid", "key_id")),
    ("part", "secret", r"(?<![A-Za-z0-9])(?i:pwd|passphrase|credentials?|auth(?:orization)?|client_?secret|private_?key|access_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{4,}", ("pwd", "passphrase", "credential", "auth", "secret", "key")),
    ("blob", "secret", r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])", ()),
    ("endpoint", "endpoint", r"(?i:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]{3,}", ("://",)),
)
#: What a strong finding stands for when weak parts look for a partner.
STRONG_ROLE = {"assign": "secret", "access": "access", "hex": "secret"}
SCOPE_BREAK = r"\n[\x20\t\r]*\n"
SPAN = "array<struct<start:int,rank:int,kind:string,role:string,end:int>>"
BREAK = "break"
#: Spans of one block of a sweep.
BLOCK = 32
NEVER, ALWAYS = -(1 << 30), 1 << 30

Step = Callable[[Column, Column], Column]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once: Spark evaluates a column that a lambda refers to again for each element, but not a lambda's variable."""
    return F.get(F.transform(F.array(value), body), 0)


def _sweep(items: Column, start: Column, step: Step, merge: Step) -> Column:
    """For each item of an array the state before it: step(state, item) folded over the items so far, from `start`.

    merge(earlier, later) joins the states of two runs of items that both began with `start`.
    """

    def over_blocks(blocks: Column) -> Column:
        def inside(ends: Column) -> Column:
            def block(b: Column, k: Column) -> Column:
                before = F.aggregate(F.slice(ends, 1, k), start, merge)
                return _let(before, lambda s: F.transform(b, lambda _, i: F.aggregate(F.slice(b, 1, i), s, step)))

            return F.flatten(F.transform(blocks, block))

        return _let(F.transform(blocks, lambda b: F.aggregate(b, start, step)), inside)

    def over(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / BLOCK).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(xs, k * BLOCK + 1, F.lit(BLOCK))), over_blocks)

    return _let(items, over)


def _marks(text: Column, kind: str, role: str, rank: int, pattern: str, group: int = 0, least: int = 0, hints: tuple[str, ...] = ()) -> Column:
    """Spans of the leftmost matches that do not overlap, in code points.

    The pieces between matches and the matches alternate, so positions are
    running sums of their lengths. A text without a match skips that work;
    plain substring tests come before the pattern.
    """
    possible = text.rlike(pattern)
    if hints:
        possible = reduce(or_, (F.contains(F.col("_low"), F.lit(h)) for h in hints)) & possible
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    # A match's own text matches in the same way, so its group is read from there.
    sized = (lambda m: F.length(F.regexp_extract(m, pattern, group))) if group else F.length
    pieces = F.zip_with(
        F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("g"), F.coalesce(F.length(m), F.lit(0)).alias("m"), F.coalesce(sized(m), F.lit(-1)).alias("size"))
    )
    add = lambda at, x: at + x.g + x.m
    spans = _let(
        pieces,
        lambda all_: F.zip_with(
            all_, _sweep(all_, F.lit(0), add, lambda a, b: a + b),
            lambda x, at: F.struct((at + x.g).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.lit(role).alias("role"), add(at, x).alias("end"), x.size.alias("size")),
        ),
    )
    kept = F.transform(F.filter(spans, lambda x: x.size >= least), lambda x: F.struct(x.start, x["rank"], x.kind, x.role, x.end))
    return F.when(possible, kept.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


ROLES = ("access", "secret", "endpoint")
WEAK_KINDS = [x[0] for x in WEAK]


def _around(parts: Column, forward: bool) -> Column:
    """For each part by role the end of the last part before it in its scope (forward), or the start of the next one after it; the same of strong spans, without regard to scopes."""
    far, best = (NEVER, F.greatest) if forward else (ALWAYS, F.least)
    edge = (lambda x: x.end) if forward else (lambda x: x.start)
    start = F.struct(*[F.lit(far).alias(r) for r in (*ROLES, "strong")], F.lit(False).alias("cut"))

    def step(s: Column, x: Column) -> Column:
        held = [F.when(x.role == BREAK, F.lit(far)).when(x.role == r, best(s[r], edge(x))).otherwise(s[r]).alias(r) for r in ROLES]
        strong = F.when(x.kind.isin(*WEAK_KINDS, BREAK), s.strong).otherwise(best(s.strong, edge(x)))
        return F.struct(*held, strong.alias("strong"), (s.cut | (x.role == BREAK)).alias("cut"))

    def merge(a: Column, b: Column) -> Column:
        held = [F.when(b.cut, b[r]).otherwise(best(a[r], b[r])).alias(r) for r in ROLES]
        return F.struct(*held, best(a.strong, b.strong).alias("strong"), (a.cut | b.cut).alias("cut"))

    return _sweep(parts, start, step, merge) if forward else F.reverse(_sweep(F.reverse(parts), start, step, merge))


def _linked(parts: Column, reach: int) -> Column:
    """Weak parts with a part of another role in reach, unless a strong span overlaps them."""

    def asked(parts: Column) -> Column:
        both = F.zip_with(_around(parts, True), _around(parts, False), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def found(x: Column, s: Column) -> Column:
            before = F.greatest(*[F.when(x.role == r, F.lit(NEVER)).otherwise(s.a[r]) for r in ROLES])
            after = F.least(*[F.when(x.role == r, F.lit(ALWAYS)).otherwise(s.b[r]) for r in ROLES])
            near = (before >= x.start - reach) | (after <= x.end + reach)
            free = (s.a.strong <= x.start) & (s.b.strong >= x.end)
            return F.struct(x.alias("x"), (x.kind.isin(*WEAK_KINDS) & near & free).alias("ok"))

        return F.transform(F.filter(F.zip_with(parts, both, found), lambda y: y.ok), lambda y: y.x)

    return _let(parts, asked)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """One row per row of docs: doc_id, strong spans, linked weak spans, as arrays of structs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), F.lower(text).alias("_low"))
    t = F.col("_text")
    strong = F.array_sort(F.concat(*[_marks(t, k, STRONG_ROLE[k], i, p, g, n, h) for i, (k, p, g, n, h) in enumerate(STRONG)]))
    weak = F.concat(*[_marks(t, k, r, len(STRONG) + i, p, hints=h) for i, (k, r, p, h) in enumerate(WEAK)])
    rows = rows.select("doc_id", "_text", strong.alias("strong"), weak.alias("weak"))
    # Weak parts need a partner, so a text without any needs no scopes.
    parts = F.array_sort(F.concat("strong", "weak", _marks(t, BREAK, BREAK, -1, SCOPE_BREAK)))
    linked = _linked(parts, reach).cast(SPAN)
    return rows.select("doc_id", "strong", F.when(F.size("weak") > 0, linked).otherwise(F.col("weak")).alias("linked"))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """Counts and digests of scan(): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = scan(docs, id_col, text_col, reach)
    count = lambda kind: F.size(F.filter("strong", lambda x: x.kind == kind)).cast("long")
    return rows.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("strong")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("strong", "linked"))).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
