"""Fill-in-the-middle: each text is cut in three by one regular expression of its own.

`regexp_count` tells how many units n a text has. Two cuts a <= b follow from the id
alone, and the row's pattern holds them as counted, possessive quantifiers,

    \\A(unit{a}+)(unit{b-a}+)(.*+)\\z

so that one match, which never steps back, captures prefix, middle and suffix; the
replacement puts them in their new order between the markers. Units are code points
unless another unit is given (any pattern whose matches, end to end, make up a text).

A text that holds a marker, an empty one and a share of the others stay plain. In all
others a marker cannot arise where parts meet either (it begins with `<`, ends with
`>`, and has neither inside), so the parts are found again by the markers alone.

Defined cases: a null text counts as empty; a null id is hashed as an empty one; rows
that repeat an id are cut at the same random numbers, each within its own text. All
columns stay, the result is a struct column of a name that no other column has. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.llm.tables import text_of, with_column

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many are transformed, and of a hundred of these so many are spm.
RATE, SPM_RATE = 90, 20
SEED = 1

#: Units that make up every text. Inside them `.` also matches line ends.
UNITS = {
    "code_point": ".",
    "line": r"(?:[^\n]*+\n|[^\n]++)",
    "word": r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)",
}
#: Units that are counted in one go, so that a long text is not held unit by unit.
BLOCK = 1024


def unit_count(text: Column, unit: str = UNITS["code_point"]) -> Column:
    """How often the unit occurs, from left to right: by blocks, then in what is left."""
    blocks = F.regexp_count(text, F.lit(f"(?s){unit}{{{BLOCK}}}+")).cast("long")
    rest = F.regexp_replace(text, F.lit(f"(?s)\\A(?:{unit}{{{BLOCK}}}+)*+"), F.lit(""))
    return blocks * BLOCK + F.regexp_count(rest, F.lit(f"(?s){unit}"))


def draw(doc_id: Column, place: int, seed: int = SEED) -> Column:
    """The place-th (from 1) 32-bit number of the SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(name.cast("binary"), 256), 8 * place - 7, 8), 16, 10).cast("long")


def pattern(first: Column, second: Column, unit: str = UNITS["code_point"]) -> Column:
    """The row's pattern: `first` units, then `second`, then the rest."""
    return F.concat(
        F.lit(f"(?s)\\A({unit}{{"), first.cast("string"),
        F.lit(f"}}+)({unit}{{"), second.cast("string"), F.lit("}+)(.*+)\\z"),
    )


def restored(output: Column, form: Column) -> Column:
    """The original text from output and form alone."""
    psm = F.lit(f"(?s)\\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\\z")
    spm = F.lit(f"(?s)\\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\\z")
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, F.lit("$1$3$2")))
        .when(form == "spm", F.regexp_replace(output, spm, F.lit("$2$3$1")))
        .otherwise(output)
    )


def transformed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = UNITS["code_point"], seed: int = SEED
) -> tuple[DataFrame, str]:
    """The documents with a struct column (n, form, prefix_units, middle_units, output);
    second, that column's name. Counts are in units, null in plain rows."""
    h = [draw(F.col(doc_id), k, seed) for k in (1, 2, 3, 4)]
    body = text_of(text)
    docs, n = with_column(docs, unit_count(body, unit))
    count = F.col(n)
    docs, cuts = with_column(docs, F.array_sort(F.array(h[0] % (count + 1), h[1] % (count + 1))))
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    plain = (body == "") | marked | (h[2] % 100 >= RATE)
    form = F.when(plain, F.lit("plain")).when(h[3] % 100 < SPM_RATE, F.lit("spm")).otherwise(F.lit("psm"))
    docs, kind = with_column(docs, form)
    prefix, middle = F.col(cuts)[0], F.col(cuts)[1] - F.col(cuts)[0]
    order = F.when(F.col(kind) == "psm", F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    order = order.otherwise(F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    moved = F.regexp_replace(body, pattern(prefix, middle, unit), order)
    cut = F.col(kind) != "plain"
    verdict = F.struct(
        count.alias("n"),
        F.col(kind).alias("form"),
        F.when(cut, prefix).alias("prefix_units"),
        F.when(cut, middle).alias("middle_units"),
        F.when(cut, moved).otherwise(body).alias("output"),
    )
    docs, name = with_column(docs, verdict)
    return docs.drop(n, cuts, kind), name
