r"""Fill-in-middle transformation by a counted-quantifier regular expression, in DataFrame functions only.

``regexp_count`` gives a text's number n of units (code points).  A digest of the seed and the row's id
then gives two cuts a <= b, whether the row stays plain, and the order of its parts.  One match of the row's own pattern
``(.{a}+)(.{b-a}+)(.*+)`` captures prefix, middle and suffix: its counted groups are
possessive, so they run through the text once and give nothing back, and one replacement writes
the parts behind their marks.  ``restored`` rebuilds the text from the output and its form alone; it can, because a
text that holds a mark stays plain and no mark begins as another one ends.

Units are counted block by block (runs of ``BLOCK`` units, then what is left behind them), so that counting keeps
a copy of the text and not one string per unit: a text of any length is counted and cut whole.  Rows are judged alone:
no shuffle, no hot key.

Defined cases: a null text is empty; an empty text is plain; a null id is spelled ``null`` in the seed; cuts may
fall together or on either end, so parts may be empty; repeated rows give the same rows again; an empty table gives none;
further columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Percent of rows that are transformed, and of those the percent with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
BLOCK = 4096
_UNIT = "(?s)."


def _check(marks: Sequence[str]) -> tuple[str, str, str]:
    """Three marks that can be told from any text around them."""
    marks = tuple(marks)
    if len(marks) != 3 or not all(marks) or len(set(marks)) != 3:
        raise ValueError(f"three different marks are needed, not {marks}")
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"mark {a!r} may run into mark {b!r}")
    return marks


def _quoted(mark: str) -> str:
    """A mark as Java's pattern takes it; every ASCII sign is escaped."""
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in mark)


def _template(*parts: str) -> Column:
    """A replacement: marks as they are, ``$k`` for groups."""
    return F.lit("".join(p if p[0] == "$" and p[1:].isdigit() else p.replace("\\", "\\\\").replace("$", "\\$") for p in parts))


def _times(n: Column) -> Column:
    """The possessive quantifier of exactly n units."""
    return F.concat(F.lit(".{"), n.cast("string"), F.lit("}+"))


def unit_count(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the number of units of a text without nulls, as a long."""
    blocks, rest = f"{name}_blocks", f"{name}_rest"
    behind = F.regexp_replace(F.col(text_col), F.concat(F.lit("(?s)\\A"), _times(F.col(blocks) * BLOCK)), F.lit(""))
    out = docs.withColumn(blocks, F.regexp_count(F.col(text_col), F.lit(f"{_UNIT}{{{BLOCK}}}+")).cast("long"))
    out = out.withColumn(rest, F.regexp_count(F.when(F.col(blocks) > 0, behind).otherwise(F.col(text_col)), F.lit(_UNIT)).cast("long"))
    return out.withColumn(name, F.col(blocks) * BLOCK + F.col(rest)).drop(blocks, rest)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits, from 1, as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, marks: Sequence[str] = MARKS,
              transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, text, n, form, prefix_units, middle_units, output) per row; ``form`` is plain, psm (prefix, suffix, middle) or spm
    (suffix, prefix, middle), the unit counts are null for plain rows."""
    p, s, m = _check(marks)
    lean = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    name = F.concat(F.lit(f"{int(seed)}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    out = unit_count(lean, "text", "n").withColumn("digest", F.sha2(name, 256))
    cuts = [_draw(F.col("digest"), k) % (F.col("n") + 1) for k in (1, 2)]
    marked = F.col("text").contains(p) | F.col("text").contains(s) | F.col("text").contains(m)
    form = (F.when((F.col("n") == 0) | marked | (_draw(F.col("digest"), 3) % 100 >= transformed), "plain")
            .when(_draw(F.col("digest"), 4) % 100 < suffix_first, "spm").otherwise("psm"))
    out = out.withColumn("form", form)
    plain = F.col("form") == "plain"
    out = out.select("doc_id", "text", "n", "form", F.when(~plain, F.least(*cuts)).alias("prefix_units"),
                     F.when(~plain, F.greatest(*cuts) - F.least(*cuts)).alias("middle_units"))
    pattern = F.concat(F.lit("(?s)\\A("), _times(F.col("prefix_units")), F.lit(")("), _times(F.col("middle_units")), F.lit(")(.*+)\\z"))
    order = F.when(F.col("form") == "psm", _template(p, "$1", s, "$3", m, "$2")).otherwise(_template(s, "$3", p, "$1", m, "$2"))
    return out.withColumn("output", F.when(plain, F.col("text")).otherwise(F.regexp_replace(F.col("text"), pattern, order)))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``output`` was made from."""
    p, s, m = map(_quoted, _check(marks))
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) per row."""
    out = transform(docs, id_col, text_col, seed).withColumn("again", restored(F.col("output"), F.col("form")))
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("again", 256).alias("restored_sha256"))
