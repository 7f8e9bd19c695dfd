"""Column expressions over one PGN game record (tag section, blank line, movetext)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each pattern opens with one literal, line start or character class, so that most positions
# of a text are passed over with a single test, and the negated classes of the frequent ones
# list single characters: Java tests those ten times faster than \s or \d. (?d): only \n
# ends a line, so U+2028 and the like inside a value do not cut it. A tag line may be
# indented by any number of blanks.
_TAG_LINE = r'(?dm)^[ \t]*+\[([^ \t\n"\]]+)[ \t]+"([^\n]*)"[ \t]*\][ \t]*$'
# First line that is neither a tag, nor blank, nor a comment line.
_MOVETEXT_START = r"(?dm)^[ \t]*[^\[ \t\n\f\x0B;%]"
# { ... }, ; to the end of the line, % lines, tag lines.
_NOT_MOVETEXT = r"(?dm)[{;](?:(?<=\{)[^}]*\}?|(?<=;)[^\n]*)|^(?:%|[ \t]*+\[)[^\n]*"
_COMMENT = r"(?dm)\{[^}]*\}?|;[^\n]*|^%[^\n]*"
_VARIATION = r"\([^()]*\)"
# A move: algebraic or coordinate form, a drop, castling, the null move. It stands after a blank
# or a dot, with or without the number before it, and ends before a suffix, a glyph or a blank,
# so other words ("e.p.", names, results) are none.
_MOVE = (
    r"(?<![^ \n\t\r\f\x0B.])[0-9]*"
    r"([KQRBNP]?[a-h]?[1-8]?[x\-]?[a-h][1-8](?:=?[QRBNKqrbnk])?[+#]*"
    r"|[KQRBNP]?@[a-h][1-8][+#]*|O-O(?:-O)?[+#]*|0-0(?:-0)?[+#]*|--|Z0|0000)"
    r"(?=[ \n\t\r\f\x0B!?$]|\z)"
)


def movetext_start(record: Column) -> Column:
    return F.regexp_instr(record, F.lit(_MOVETEXT_START))


def header_text(record: Column, start: Column) -> Column:
    """The record up to its movetext, with \\" and \\\\ read as " and \\."""
    header = F.when(start > 0, F.substring(record, F.lit(1), start - 1)).otherwise(record)
    unescaped = F.regexp_replace(header, r'\\(["\\])', "$1")
    return F.when(F.contains(record, F.lit("\\")), unescaped).otherwise(header)


def tag_names(header: Column) -> Column:
    """Tag names, last line first, so that a lookup finds the last of repeated tags."""
    return F.reverse(F.regexp_extract_all(header, F.lit(_TAG_LINE), F.lit(1)))


def tag_values(header: Column) -> Column:
    return F.reverse(F.regexp_extract_all(header, F.lit(_TAG_LINE), F.lit(2)))


def tag_value(names: Column, values: Column, tag: str, default: str = "") -> Column:
    # Kept short on purpose: ten of these share one generated method, and a method that
    # grows past what the JVM compiles runs many times slower.
    return F.coalesce(F.get(values, F.array_position(names, tag).cast("int") - 1), F.lit(default))


def _without_variations(text: Column) -> Column:
    """Text outside all parentheses, at any nesting depth; a stray ')' is ignored."""
    parts = F.split(F.concat(F.lit(")"), text), r"(?=[()])")

    def step(state: Column, part: Column) -> Column:
        depth = F.greatest(
            state["depth"] + F.when(F.startswith(part, F.lit("(")), 1).otherwise(-1), F.lit(0)
        )
        kept = F.when(depth == 0, F.concat(state["kept"], F.lit(" "), F.substring(part, 2, 2**31 - 1)))
        return F.struct(depth.alias("depth"), kept.otherwise(state["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kept"))
    return F.aggregate(parts, start, step, lambda state: state["kept"])


def plain_movetext(record: Column) -> Column:
    """The record without its tag lines and comments."""
    return F.regexp_replace(record, _NOT_MOVETEXT, " ")


def without_shallow_variations(plain: Column) -> Column:
    """Two levels of closed variations dropped, which is all that most games have."""
    once = F.regexp_replace(plain, _VARIATION, " ")
    return F.when(F.contains(plain, F.lit("(")), F.regexp_replace(once, _VARIATION, " ")).otherwise(plain)


def main_text(plain: Column) -> Column:
    """The part outside variations. Costs a lambda only where a parenthesis is left."""
    return F.when(F.contains(plain, F.lit("(")), _without_variations(plain)).otherwise(
        F.replace(plain, F.lit(")"), F.lit(" "))
    )


def main_moves(text: Column) -> Column:
    """The moves as a list; glyphs, numbers, the result and words that are no moves dropped."""
    return F.regexp_extract_all(text, F.lit(_MOVE), F.lit(1))


def one_game(record: Column, start: Column) -> Column:
    """A condition that holds for a record with one game, and stops the query at one that holds
    more than one or a part of one.

    A tag line after the movetext, outside comments, is another game's. A movetext that opens
    with a closing brace comes from a comment that was cut at a line which looks like a tag. Only
    records with a line after the movetext's first that opens like a tag are looked at closely.
    ``start`` is where the movetext begins, see :func:`movetext_start`.
    """
    movetext = F.substring(record, start, F.lit(2**31 - 1))
    second = F.contains(movetext, F.lit("\n[")) | F.contains(movetext, F.lit("\n "))
    second = second & F.regexp_like(F.regexp_replace(movetext, _COMMENT, " "), F.lit(_TAG_LINE))
    problem = F.raise_error(F.concat(
        F.lit("not one game per record: choose another opening for files whose games do not open alike. It begins "),
        F.substring(record, 1, 80),
    )).cast("boolean")
    return F.when((start > 0) & (F.startswith(movetext, F.lit("}")) | second), problem).otherwise(F.lit(True))
