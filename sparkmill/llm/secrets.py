"""Secret scans, in DataFrame functions only.

Three base kinds are regular expressions.  Their spans come from the text between
matches: ``split`` and ``regexp_extract_all`` give the pieces in turn, and running
lengths give code-point positions.  On top, maximal runs of each character class
(hex, base64) are candidate strings; a window slides over each, and the Shannon
entropy of its characters is kept up by adding the count of the character that
enters and taking off the one that leaves.  Windows at or above the class's limit
are joined to spans.  Candidates that match the allow-list as a whole are passed over.

Entropies are sums of c * log2(c) rounded to 2**-20, as integers, so that a window on the
limit is judged alike everywhere.  Every row is judged alone: no shuffle, no hot key.

Texts and candidates of any length are read whole, and the work grows in line with it: positions are sums over
blocks of matches, candidates are judged in overlapping stretches, and no list or string grows by one for each
match or character of a text.

Defined cases: a null text is empty and has no spans; spans of different kinds may
overlap, all are reported; repeated rows are judged each; an empty table gives none;
further columns, whatever their names, are not read."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: How work on a long text is cut up; no result depends on them.
BLOCK, STRETCH = 128, 1024
_BITS, _PER_LONG = 5, 12  # a window's counts, packed: up to 31 of a character, twelve characters a long


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of at least ``window`` characters of ``alphabet``; ``bits`` is the limit."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float

    def __post_init__(self):
        if not 1 < self.window < 1 << _BITS:
            raise ValueError(f"a window holds 2 to {(1 << _BITS) - 1} characters")

    @property
    def terms(self) -> list[int]:
        """c * log2(c) for counts 0..window, in units of 2**-20."""
        return [0] + [round(c * math.log2(c) * (1 << 20)) for c in range(1, self.window + 1)]

    @property
    def most(self) -> int:
        """Entropy is log2(window) - sum / window: the largest sum that reaches the limit."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * (1 << 20))


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (CharacterClass("entropy_hex", "[0-9a-fA-F]", _DIGITS + "abcdefABCDEF", 20, 3.0),
           CharacterClass("entropy_base64", "[A-Za-z0-9+/_=-]", _LOWER.upper() + _LOWER + _DIGITS + "+/_=-", 20, 3.75))
#: Whole candidates that are no secrets: letters alone, digits alone, words or numbers joined by
#: marks, UUIDs, and documentation's examples.
ALLOWED = (r"[A-Za-z]+", r"[0-9]+", r"([A-Za-z]+|[0-9]+)([+/_=-]+([A-Za-z]+|[0-9]+))*[+/_=-]*", r"[+/_=-]+",
           r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r".*EXAMPLE(KEY)?")
#: The joined words for Java, whose stack grows with each turn of a group that may give back; what these
#: repeats match can be split in one way only, so nothing is lost when they keep it.
_JAVA = {ALLOWED[2]: r"(?:[A-Za-z]++|[0-9]++)(?:[+/_=-]++(?:[A-Za-z]++|[0-9]++))*+[+/_=-]*+"}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is formed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(values: Column) -> Column:
    """The array in slices of BLOCK."""
    at = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(BLOCK))
    return F.transform(at, lambda i: F.slice(values, i + 1, BLOCK))


def _before(values: Column, join, levels: int = 2) -> Column:
    """Per place, ``join`` (sum, maximum: of integers from 0) of all values before it.

    A list that grows by one is copied at each step, so only lists of a block grow: block totals are joined
    first (level by level), then the places inside each block."""
    if levels == 0:
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(values, start, lambda st, v: F.struct(join(st["at"], v).alias("at"), F.concat(st["out"], F.array(st["at"])).alias("out")),
                           lambda st: st["out"])

    def placed(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), join))
        return _let(_before(totals, join, levels - 1), lambda heads: F.flatten(F.transform(
            blocks, lambda b, i: _let(F.get(heads, i), lambda head: F.transform(_before(b, join, 0), lambda v: join(v, head))))))

    return _let(_blocks(values), placed)


def _sum(a, b):
    return a + b


def _matches(text: Column, pattern: str, likely: Column) -> Column:
    """array<struct<start, found>> of the leftmost non-overlapping matches."""
    def placed(pieces, found):
        def starts(before):
            lengths = F.transform(found, lambda m, i: F.get(before, i) + F.char_length(m))
            return _let(_before(lengths, _sum), lambda at: F.transform(
                found, lambda m, i: F.struct((F.get(at, i) + F.get(before, i)).alias("start"), m.alias("found"))))

        return _let(F.transform(pieces, lambda p: F.char_length(p)), starts)

    matches = _let(F.split(text, pattern, -1), lambda pieces: _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                                                                  lambda found: placed(pieces, found)))
    return F.when(likely, matches).otherwise(F.expr("cast(array() as array<struct<start:int,found:string>>)"))


def _span(order: int, kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(order).alias("order"), end.cast("int").alias("end"), F.lit(kind).alias("kind"))


def _spans(order: int, kind: str, matches: Column) -> Column:
    return F.transform(matches, lambda m: _span(order, kind, m["start"], m["start"] + F.char_length(m["found"])))


def _cut(text: Column) -> Column:
    """The text in strings of STRETCH code points; the last may be shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))


def _high_entropy(found: Column, c: CharacterClass) -> Column:
    """array<struct<s, e>>: the windows of a candidate at or above the limit, joined; end exclusive.

    Windows are judged stretch by stretch, each lengthened by the characters its last windows still need,
    and what touches across stretches is joined at the end: the work grows with the candidate's length only."""
    def stretches(pieces):
        return F.flatten(F.transform(pieces, lambda p, k: _windows(
            F.concat(p, F.coalesce(F.substring(F.get(pieces, k + 1), 1, c.window - 1), F.lit(""))), k * STRETCH, c)))

    return _let(_let(_cut(found), stretches), _joined)


def _joined(spans: Column) -> Column:
    """Spans in order of start and end, those that touch made one."""
    first = F.filter(spans, lambda x, i: (i == 0) | (x["s"] > F.get(spans, i - 1)["e"]))
    last = F.filter(spans, lambda x, i: (i == F.size(spans) - 1) | (F.get(spans, i + 1)["s"] > x["e"]))
    return _let(last, lambda ends: F.transform(first, lambda x, i: F.struct(x["s"].alias("s"), F.get(ends, i)["e"].alias("e"))))


def _windows(text: Column, at: Column, c: CharacterClass) -> Column:
    """array<struct<s, e>> of one stretch that starts at ``at``.  The counts of a window are kept in longs of
    _PER_LONG counts of _BITS bits; the character that enters adds one, the one that leaves takes one off."""
    codes = F.transform(F.split(text, ""), lambda x: F.instr(F.lit(c.alphabet), x) - 1)

    def moves(codes):
        def move(code, i):
            left = F.when(i >= c.window, F.get(codes, i - c.window)).otherwise(-1)
            place = lambda x: (F.floor(x / _PER_LONG).cast("int"), (x % _PER_LONG * _BITS).cast("int"))
            (w_in, s_in), (w_out, s_out) = place(code), place(F.greatest(left, F.lit(0)))
            return F.struct((i + 1).alias("i"), (code == left).alias("same"), (left >= 0).alias("full"),
                            w_in.alias("w_in"), s_in.alias("s_in"), w_out.alias("w_out"), s_out.alias("s_out"))

        return F.transform(codes, move)

    longs = -(-len(c.alphabet) // _PER_LONG)
    gain = F.array(*[F.lit(y - x).cast("long") for x, y in zip(c.terms, c.terms[1:])])
    joined = "array<struct<s:int,e:int>>"
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), longs).alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(-1).alias("s"), F.lit(-1).alias("e"), F.expr(f"cast(array() as {joined})").alias("out"))
    one = F.lit(1).cast("long")

    def count(counts, word, shift):
        return F.call_function("shiftright", F.get(counts, word), shift).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def slide(st, m):
        n_in, n_out = count(st["counts"], m["w_in"], m["s_in"]), count(st["counts"], m["w_out"], m["s_out"])
        total = st["sum"] + F.when(m["same"], 0).otherwise(F.get(gain, n_in) - F.when(m["full"], F.get(gain, n_out - 1)).otherwise(0))
        counts = F.when(m["same"], st["counts"]).otherwise(F.array(*[
            F.get(st["counts"], F.lit(w)) + F.when(m["w_in"] == w, F.call_function("shiftleft", one, m["s_in"])).otherwise(0)
            - F.when(m["full"] & (m["w_out"] == w), F.call_function("shiftleft", one, m["s_out"])).otherwise(0) for w in range(longs)]))
        return F.struct(counts.alias("counts"), total.alias("sum"), m["i"].alias("i"), st["s"].alias("s"), st["e"].alias("e"), st["out"].alias("out"))

    def judge(st):
        hit = (st["i"] >= c.window) & (st["sum"] <= c.most)
        begin = st["i"] - c.window
        apart = hit & (begin > st["e"])
        out = F.when(apart & (st["e"] > 0), F.concat(st["out"], F.array(F.struct(st["s"].alias("s"), st["e"].alias("e"))))).otherwise(st["out"])
        return F.struct(st["counts"].alias("counts"), st["sum"].alias("sum"), F.when(apart, begin).otherwise(st["s"]).alias("s"),
                        F.when(hit, st["i"]).otherwise(st["e"]).alias("e"), out.alias("out"))

    last = lambda st: F.when(st["e"] > 0, F.concat(st["out"], F.array(F.struct(st["s"].alias("s"), st["e"].alias("e"))))).otherwise(st["out"])
    spans = F.aggregate(_let(codes, moves), start, lambda st, m: _let(slide(st, m), judge), last)
    return F.transform(spans, lambda x: F.struct((x["s"] + at).alias("s"), (x["e"] + at).alias("e")))


def scan(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
         text_col: str = "text") -> DataFrame:
    """``docs`` with ``secret_base`` and ``secret_spans``: arrays of (start, order, end, kind) in order of
    start, then kind; the second holds the first and the entropy spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("secret_base", _base(text))
    extra = []
    for k, c in enumerate(classes):
        run = f"{c.pattern}{{{c.window},}}"
        name = f"secret_candidates_{k}"
        allow = "^(" + "|".join(_JAVA.get(a, a) for a in allowed) + ")$"
        out = out.withColumn(name, F.filter(_matches(text, run, text.rlike(f"{c.pattern}{{{c.window}}}")), lambda m: ~m["found"].rlike(allow)))
        extra.append(_entropy(F.col(name), 3 + k, c))
    spans = F.array_sort(F.concat("secret_base", *extra))
    return out.withColumn("secret_spans", spans).drop(*[f"secret_candidates_{k}" for k in range(len(classes))])


def _entropy(candidates: Column, order: int, c: CharacterClass) -> Column:
    def spans(m):
        return F.transform(_high_entropy(m["found"], c), lambda w: _span(order, c.kind, m["start"] + w["s"], m["start"] + w["e"]))

    return F.flatten(F.transform(candidates, spans))


def _base(text: Column) -> Column:
    assign = F.filter(_matches(text, ASSIGN, text.rlike(ASSIGN)),
                      lambda m: F.char_length(F.regexp_extract(m["found"], ASSIGN, 1)) >= ASSIGN_LEAST)
    # A run that is too short holds no match that is long enough, so the length can stand in the pattern.
    access = _matches(text, ACCESS[:-1] + f"{{{ACCESS_LEAST - 4},}}", text.contains("AKIA"))
    hexes = _matches(text, HEX[:-1] + f"{{{HEX_LEAST},}}", text.rlike(HEX[:-1] + f"{{{HEX_LEAST}}}"))
    return F.array_sort(F.concat(_spans(0, "assign", assign), _spans(1, "access", access), _spans(2, "hex", hexes)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row."""
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return found.select("doc_id", *[count(F.col("secret_base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(listed(F.col("secret_base")), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``."""
    def piece(cut, start, end):
        """Code points start to end (exclusive) out of the stretches they lie in: finding a place by counting from
        the text's head for each span would be quadratic."""
        def part(k):
            head = F.greatest(start - k * STRETCH, F.lit(0))
            return F.substring(F.get(cut, k), head + 1, F.least(end - k * STRETCH, F.lit(STRETCH)) - head)

        stretches = F.sequence(F.floor(start / STRETCH).cast("int"), F.floor((end - 1) / STRETCH).cast("int"))
        return F.when(end > start, F.array_join(F.transform(stretches, part), "")).otherwise("")

    def joined(cut, spans, at):  # at: where the spans before each end; one that touches or overlaps them only lengthens the gap
        marked = F.transform(spans, lambda s, i: F.when((i == 0) | (s["start"] > F.get(at, i)),
                                                        F.concat(piece(cut, F.get(at, i), s["start"]), F.lit(mark))).otherwise(""))
        end = F.greatest(F.array_max(at), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(marked, ""), piece(cut, end, F.char_length(text)))

    done = _let(_cut(text), lambda cut: _let(spans, lambda found: _let(
        _before(F.transform(found, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), lambda at: joined(cut, found, at))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs``, all columns, with secrets replaced in the text, and its length set anew where that changed it."""
    found = scan(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")))
    found = found.withColumn("clean", redacted(F.col("text"), F.col("secret_spans")))
    changed = F.size("secret_spans") > 0
    own = {text_col: F.col("clean")}
    if length_col in docs.columns:
        own[length_col] = F.when(changed, F.char_length("clean").cast(docs.schema[length_col].dataType)).otherwise(F.col("row")[length_col])
    return found.select(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
