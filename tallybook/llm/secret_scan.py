"""Secrets in whole texts, in SQL functions only: known patterns, and runs of high entropy.

The pattern kinds come first. Beside them every run of 20 or more characters that keys are made of
is a candidate: its class (hex digits, letters and digits, base64) sets alphabet and threshold, and Shannon
entropy is followed over a window that slides through the run. The window's counts per character are kept up
to date by one entering and one leaving character, and with them the sum of c * log2(c) as a whole number,
so that nothing drifts. Runs on the allow-list are left alone. Of a run that holds a pattern's span the
stretches before, between and behind such spans are candidates of their own.

Arrays that grow are built in parts and characters are taken from arrays, never by walking the text again, so the
time for a text grows with its length, whatever stands in it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.arrays import let, running

# The pattern kinds, their minimum lengths and the regular expressions of the contract.
BASE_KINDS = ["assign", "access", "hex"]
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12)
ACCESS = (r"AKIA[A-Z0-9]+", 18)
HEX = (r"[0-9a-f]{16,}", 16)  # shorter runs fail in any case, and a run is matched whole

WINDOW = 20
MIN_RUN = 20
SCALE = 1 << 20
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Class: (what the whole run has to match, alphabet with case folded where it carries nothing, least entropy in bits).
CLASSES = {
    "entropy_hex": (r"^[0-9a-fA-F]+$", "0123456789abcdef", 3.0),
    "entropy_alnum": (r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 3.6),
    "entropy_base64": (r"^[A-Za-z0-9+/_=-]+$", "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", 3.8),
}
#: Runs that are no secrets: letters or digits alone between separators (words, paths, numbers, rules), and UUIDs.
ALLOW = [r"^(?:[A-Za-z]+|[0-9]+)?(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*$",
         r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"]
KINDS = BASE_KINDS + list(CLASSES)
MASK = "\u0001"  # stands for the characters of a span; in no run
EMPTY = "cast(array() as array<struct<start:bigint,rank:int,end:bigint>>)"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, body: str) -> str:
    """``body`` (an array of spans) with ``found`` (the matches), ``gaps`` (what stands between them, one more) and ``ends``.

    Spark gives no positions of matches; they follow from the lengths of the matches and of the pieces between them.
    """
    ends = running("transform(found, (f, i) -> cast(length(gaps[i]) + length(f) as bigint))", "c + x")
    some = let(f"split({text}, {_text(pattern)}, -1)", "gaps", let(ends, "ends", body))
    return let(f"regexp_extract_all({text}, {_text(pattern)}, 0)", "found", f"if(size(found) = 0, {EMPTY}, {some})")


def located(text: str, pattern: str, rank: int, least: int, group: int = 0) -> str:
    """Spans (start, rank, end; in characters, end exclusive) of the matches whose ``group`` has ``least`` characters."""
    span = f"named_struct('start', ends[i] - length(f), 'rank', {rank}, 'end', ends[i])"
    kept = f"filter(transform(found, (f, i) -> if(length(kept[i]) >= {least}, {span}, null)), s -> s is not null)"
    return matches(text, pattern, let(f"regexp_extract_all({text}, {_text(pattern)}, {group})", "kept", kept))


def joined(spans: str) -> str:
    """Spans by start, those that overlap as one: (start, end)."""
    heads = ("filter(sequence(0, size(sorted) - 1), i -> i = 0 or sorted[i].start >= tops[i - 1])")
    union = ("transform(heads, (h, j) -> named_struct('start', sorted[h].start, 'end', "
             "tops[if(j + 1 < size(heads), heads[j + 1], size(sorted)) - 1]))")
    return let(f"array_sort({spans})", "sorted", let(running("transform(sorted, s -> s.end)", "greatest(c, x)"), "tops",
                f"if(size(sorted) = 0, cast(array() as array<struct<start:bigint,end:bigint>>), {let(heads, 'heads', union)})"))


def replaced(text: str, unions: str, put: str, before: str = "p") -> str:
    """``text`` with each of the joined spans ``u`` given as ``put``, and what stands between them as ``before`` (of p)."""
    piece = "array_join(slice(chars, cast(u0 as int) + 1, cast(u1 - u0 as int)), '')"
    part = let("if(i = 0, 0L, us[i - 1].end)", "u0", let("u.start", "u1", let(piece, "p", f"concat({before}, {put})")))
    rest = let("us[size(us) - 1].end", "u0", let("cast(size(chars) as bigint)", "u1", let(piece, "p", before)))
    return let(unions, "us", let(f"split({text}, '')", "chars",
                f"concat(array_join(transform(us, (u, i) -> {part}), ''), {rest})"))


def least_sum(run: str, alphabet: str) -> str:
    """The least sum of c * log2(c) (times SCALE) over the windows of a run: its greatest entropy."""
    gain = "array(" + ", ".join(f"{round(c * math.log2(c) * SCALE) if c else 0}L" for c in range(WINDOW + 2)) + ")"  # a character enters before one leaves
    n = len(alphabet)

    def moved(counts, at, by):
        return (f"concat(slice({counts}, 1, {at} - 1), array({counts}[{at} - 1] {by}), "
                f"slice({counts}, {at} + 1, {n}))")

    enter = f"instr('{alphabet}', cs[i - 1])"
    leave = f"instr('{alphabet}', cs[i - {WINDOW} - 1])"
    added = (f"named_struct('n', {moved('a.n', 'e', '+ 1')}, "
             "'s', a.s + g[a.n[e - 1] + 1] - g[a.n[e - 1]], 'least', a.least)")
    removed = (f"named_struct('n', {moved('b.n', 'l', '- 1')}, "
               "'s', b.s + g[b.n[l - 1] - 1] - g[b.n[l - 1]], 'least', b.least)")
    slid = f"if(i > {WINDOW}, {let(leave, 'l', removed)}, b)"
    noted = f"named_struct('n', c.n, 's', c.s, 'least', if(i >= {WINDOW}, least(c.least, c.s), c.least))"
    step = let(enter, "e", let(added, "b", let(slid, "c", noted)))
    start = f"named_struct('n', array_repeat(0, {n}), 's', 0L, 'least', {1 << 62}L)"
    walk = f"aggregate(sequence(1, size(cs)), {start}, (a, i) -> {step}, a -> a.least)"
    return let(gain, "g", let(f"split({run}, '')", "cs", walk))


def candidate_rank(run: str) -> str:
    """SQL for the rank of the class whose threshold a run reaches, or null."""
    cases = []
    for name, (pattern, alphabet, bits) in CLASSES.items():
        most = int((math.log2(WINDOW) - bits) * WINDOW * SCALE)
        folded = f"lower({run})" if name == "entropy_hex" else run
        cases.append(f"when {run} rlike {_text(pattern)} then "
                     f"if({least_sum(folded, alphabet)} <= {most}L, {KINDS.index(name)}, null)")
    allowed = " or ".join(f"{run} rlike {_text(p)}" for p in ALLOW)
    return f"if(length({run}) < {MIN_RUN} or {allowed}, null, case {' '.join(cases)} end)"


def masked(text: str, base: str) -> str:
    """``text`` with its base spans masked by a character that is in no run, so that a run ends there."""
    hidden = replaced(f"translate({text}, '{MASK}', ' ')", joined(base), f"repeat('{MASK}', cast(u.end - u.start as int))")
    return f"if(size({base}) = 0, {text}, {hidden})"


def entropy_spans(seen: str) -> str:
    """Spans of the runs of high entropy in a masked text.

    One separator where a run meets a base span joins the two and belongs to neither.
    """
    front = f"if(right(gaps[i], 1) = '{MASK}' and left(f, 1) rlike '[+/_=-]', 1, 0)"
    back = f"if(left(gaps[i + 1], 1) = '{MASK}' and right(f, 1) rlike '[+/_=-]', 1, 0)"
    own = "substring(f, x + 1, length(f) - x - y)"
    span = f"named_struct('start', ends[i] - length(f) + x, 'rank', {candidate_rank('own')}, 'end', ends[i] - y)"
    each = let(front, "x", let(back, "y", let(own, "own", span)))
    return matches(seen, RUN, f"filter(transform(found, (f, i) -> {each}), r -> r.rank is not null)")


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _with_spans(docs: DataFrame, text_column: str) -> tuple[DataFrame, str, list[str]]:
    """``docs`` with (start, rank, end) of all spans by start, then kind; the column's name, and those to drop."""
    text, base, seen, spans = (fresh(docs, n) for n in ("scanned", "base_spans", "masked_text", "all_spans"))
    found = docs.withColumn(text, F.coalesce(F.col(text_column), F.lit("")))
    found = found.withColumn(base, F.expr(let(text, "t", "concat(" + ", ".join([
        located("t", ASSIGN[0], 0, ASSIGN[1], group=2), located("t", ACCESS[0], 1, ACCESS[1]),
        located("t", HEX[0], 2, HEX[1])]) + ")")))
    found = found.withColumn(seen, F.expr(masked(text, base)))
    found = found.withColumn(spans, F.expr(f"array_sort(concat({base}, {entropy_spans(seen)}))"))
    return found, spans, [text, base, seen, spans]


def find_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, kind, end) by start, then kind; characters, end exclusive.

    Of a run of high entropy only what lies outside the patterns' spans is reported. Null and empty texts have no spans;
    repeated rows each get theirs; an empty table stays empty; a column of docs named secret_spans is replaced. Texts are
    read whole, in time that grows with their length.
    """
    names = ", ".join(f"'{k}'" for k in KINDS)
    found, spans, steps = _with_spans(docs.drop("secret_spans"), text_column)
    return found.withColumn("secret_spans", F.expr(
        f"transform({spans}, s -> named_struct('start', s.start, 'kind', array({names})[s.rank], 'end', s.end))")).drop(*steps)


def redact(docs: DataFrame, text_column: str = "text", mask: str = "[secret]",
           length_column: str | None = None) -> DataFrame:
    """``docs`` with every secret span of the text replaced by ``mask`` (overlapping spans once); no row is lost.

    A null text stays null; texts without secrets are unchanged, repeated rows too; an empty table stays empty. No other
    column is touched but ``length_column``, which follows where a text changes.
    """
    found, spans, _ = _with_spans(docs, text_column)
    done = fresh(found, "redacted")
    found = found.withColumn(done, F.expr(f"if(size({spans}) = 0, null, {replaced(f'`{text_column}`', joined(spans), _text(mask))})"))
    new = {text_column: F.coalesce(F.col(done), F.col(text_column))}
    if length_column:
        kind = docs.schema[length_column].dataType
        new[length_column] = F.coalesce(F.length(done), F.col(length_column)).cast(kind)
    return found.withColumns(new).select(*docs.columns)
