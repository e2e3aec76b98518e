"""Fill-in-the-middle: each text cut into prefix, middle and suffix, and written in another order.

Texts are counted and cut in whole lines. The cuts of a row become counts in a pattern of its
own, ``((?:line){a}+)((?:line){b-a}+)(.*)``: possessive, so that it never goes back over lines
it has counted, however many. One replacement by that pattern writes the whole output; what is
said about the parts is read back from the output by its markers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One unit of a text, and the markers.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Seed, percentage of texts that are transformed, percentage of those that begin with the suffix.
SEED, RATE, SUFFIX_FIRST = 7, 100, 50


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2 ** 32 that depend on the id alone; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _pattern(first: Column, second: Column) -> Column:
    """Prefix, middle and suffix as groups 1 to 3, for cuts after ``first`` and ``second`` lines."""

    def lines(count: Column) -> Column:
        return F.concat(F.lit(f"((?:{LINE}){{"), count.cast("string"), F.lit("}+)"))

    return F.concat(F.lit(r"\A"), lines(first), lines(second - first), F.lit(r"([\s\S]*)\z"))


def infilled(df: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, output``: lines of the text, and the text as ``plain``, ``psm`` or ``spm``.

    A null text counts as empty. Empty texts stay plain, and so do texts that hold a marker, so
    that each marker of another form occurs once. Cuts depend on the id and the number of lines;
    equal rows each keep their row. An empty table gives an empty result; other columns, whatever
    their names, are left out.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", F.regexp_count("text", F.lit(LINE)).cast("long").alias("n"), F.array(*draws(F.col("doc_id"), seed)).alias("h"))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("n") == 0) | marked | (F.col("h")[2] % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h")[3] % 100 < suffix_first, "spm").otherwise("psm")
    cuts = [F.col("h")[i] % (F.col("n") + 1) for i in (0, 1)]
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    moved = F.regexp_replace("text", _pattern(F.col("first"), F.col("second")), order)
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(moved)
    return rows.select("doc_id", "n", "form", output.alias("output"))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of."""

    def parts(*markers: str) -> str:
        return r"\A" + "".join(rf"{m}([\s\S]*)" for m in markers) + r"\z"

    psm = F.regexp_replace(output, F.lit(parts(PREFIX, SUFFIX, MIDDLE)), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(parts(SUFFIX, PREFIX, MIDDLE)), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(written: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of outputs."""
    form, output = F.col("form"), F.col("output")
    at = {m: F.instr(output, m) for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(form == "psm", at[SUFFIX] - at[PREFIX]).when(form == "spm", at[MIDDLE] - at[PREFIX]) - len(PREFIX)
    middle = F.when(form != "plain", F.char_length(output) + 1 - at[MIDDLE] - len(MIDDLE))
    return written.select(
        "doc_id",
        "n",
        "form",
        prefix.cast("long").alias("prefix_chars"),
        middle.cast("long").alias("middle_chars"),
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(form, output), 256).alias("restored_sha256"),
    )


#: The digests over ``documents``; the parts are cut from a list of lines, and the text itself is what is restored.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
    CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4
  FROM t
), v AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
    greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), w AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(lines[1:a], ''), '') AS p,
    coalesce(array_to_string(lines[a + 1:b], ''), '') AS m, coalesce(array_to_string(lines[b + 1:], ''), '') AS s
  FROM v
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM w
"""
