"""Objects of JSON text, told by quotes and brackets.

A text is cut after every ``}``. What a piece does to the reader is known without the
others: whether it changes between inside and outside of a string, and by how much it
deepens the nesting, once if it starts outside a string and once if inside. A running fold
over the pieces gives the state after each, so the objects at one depth are whole
runs of pieces, whatever their strings hold. Escaped characters never reach over a
cut: a cut stands after ``}``, which begins no escape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.operators.rows import let, running

MAP = "map<string,string>"
CUT = r"(?<=\})"


def pieces(text: Column) -> Column:
    return F.split(text, CUT)


def lexed(piece: Column) -> Column:
    """``turn``: 1 if the piece ends the other side of a quote than it began; ``out`` and ``in``:
    how much deeper it leads when it begins outside or inside a string."""
    bare = F.split(F.regexp_replace(piece, r"\\[\s\S]", ""), '"', -1)
    side = lambda odd: F.array_join(F.filter(bare, lambda _, i: i % 2 == odd), "")
    opened = lambda t: F.length(t) - F.length(F.translate(t, "{[", ""))
    closed = lambda t: F.length(t) - F.length(F.translate(t, "}]", ""))
    deeper = lambda odd: let(side(odd), lambda t: opened(t) - closed(t))
    return F.struct(
        ((F.size(bare) - 1) % 2).alias("turn"), deeper(0).alias("out"), deeper(1).alias("in"),
    )


def _after(state: Column, piece: Column) -> Column:
    """State after a piece: twice the depth, and one more inside a string."""
    deeper = F.when(state % 2 == 0, piece["out"]).otherwise(piece["in"])
    # the remainder of a negative depth is negative
    inside = F.abs(state % 2).bitwiseXOR(piece["turn"])
    return F.shiftleft(F.shiftright(state, 1) + deeper, 1) + inside


def own_text(run: Column) -> Column:
    """The object at the end of a run of elements, of which only the first may lack a comma before it."""
    rest = F.regexp_replace(run, r"^\s*[\[,]", "")
    alone = F.ltrim(F.translate(F.left(rest, F.lit(64)), "\n\t\r", "   ")).startswith("{")
    last = F.try_element_at(F.from_json(F.concat(F.lit("["), rest, F.lit("]")), "array<string>"), F.lit(-1))
    return F.when(alone, rest).otherwise(last)


def depth_of_records(text: Column) -> Column:
    """Depth around the records: 1 in an array, 0 where objects follow each other."""
    return F.ltrim(F.translate(F.left(text, F.lit(64)), "\n\t\r", "   ")).startswith("[").cast("int")


def object_texts(text: Column) -> Column:
    """Texts of the whole objects of an array, or of objects after each other, in order.

    What is no object is left out, and so is an object the text cuts off, with all it holds.
    """

    def found(cut: Column, states: Column) -> Column:
        done = 2 * depth_of_records(text)
        ends = F.filter(
            F.transform(states, lambda s, i: F.when((s == done) & F.get(cut, i).endswith("}"), i)),
            lambda i: i.isNotNull(),
        )

        def run(all_ends: Column) -> Column:
            first = lambda k: F.when(k > 0, F.get(all_ends, k - 1) + 1).otherwise(0)
            return F.transform(
                all_ends,
                lambda i, k: own_text(F.array_join(F.slice(cut, first(k) + 1, i - first(k) + 1), "")),
            )

        return F.filter(let(ends, run), lambda t: t.isNotNull())

    return let(pieces(text), lambda cut: let(
        running(F.transform(cut, lexed), F.lit(0), _after, "int"), lambda states: found(cut, states)
    ))


def record(text: Column) -> Column:
    """An object as a map of its values as text; of a key that is said twice, the last value."""

    def last_values(m: Column) -> Column:
        keys, values = F.map_keys(m), F.map_values(m)
        once = F.array_distinct(keys)
        from_end = F.reverse(keys)
        last = F.transform(once, lambda k: F.get(values, F.size(keys) - F.array_position(from_end, k).cast("int")))
        return F.when(F.size(once) == F.size(keys), m).otherwise(F.map_from_arrays(once, last))

    return let(F.from_json(text, MAP), last_values)


def said_twice(records: Column) -> Column:
    """Whether any record of an array repeats a key."""
    return F.exists(records, lambda m: F.size(F.array_distinct(F.map_keys(m))) < F.size(m))


def records_of(texts: Column) -> Column:
    """Texts of objects as records, without those that can't be read."""
    return F.filter(F.transform(texts, record), lambda m: m.isNotNull())
