"""Entity tags held as arrays, one row per sentence: everything here stays inside the row, so
scoring a corpus needs no shuffle until the counts are summed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from clipquarry.functions.columns import col, let, no_strings, positions
from clipquarry.schema import SPELT_OUT

OUTSIDE = "O"


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def tag_names(tag_ids: Column | str, names: list[str]) -> Column:
    """Integer tags to their names."""
    table = F.array(*[F.lit(n) for n in names])
    return F.transform(col(tag_ids), lambda i: F.get(table, i))


def map_tags(tags: Column | str, mapping: dict[str, str], default: str = OUTSIDE) -> Column:
    """Each tag looked up in a table; the default for tags not in it."""
    table = _literal_map(mapping)
    return F.transform(
        col(tags), lambda t: F.coalesce(F.try_element_at(table, t), F.lit(default))
    )


def runs(flags: Column) -> Column:
    """``array<struct<start,stop>>``: the maximal runs of true flags, both ends inclusive."""

    def found(flag: Column) -> Column:
        on = lambda i: F.coalesce(F.get(flag, i), F.lit(False))
        first = F.filter(positions(flag), lambda i: on(i) & ~on(i - 1))
        last = F.filter(positions(flag), lambda i: on(i) & ~on(i + 1))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), b.alias("stop")))

    return let(flags, found)


def entity_spans(tags: Column | str) -> Column:
    """``array<struct<type,start,stop>>`` of BIO tags, both ends inclusive. An ``I-`` tag after
    ``O`` or after another type opens a span."""
    kind = lambda t: F.substr(t, F.lit(3))

    def spans(tag: Column) -> Column:
        def opens(t: Column, i: Column) -> Column:
            before = F.coalesce(F.get(tag, i - 1), F.lit(OUTSIDE))
            fresh = (before == OUTSIDE) | F.startswith(t, F.lit("B")) | (kind(before) != kind(t))
            return (t != OUTSIDE) & fresh

        def between(opening: Column) -> Column:
            first = F.filter(positions(tag), lambda i: F.get(opening, i))
            last = F.filter(
                positions(tag),
                lambda i: (F.get(tag, i) != OUTSIDE)
                & (
                    (F.coalesce(F.get(tag, i + 1), F.lit(OUTSIDE)) == OUTSIDE)
                    | F.get(opening, i + 1)
                ),
            )
            return F.zip_with(
                first,
                last,
                lambda a, b: F.struct(
                    kind(F.get(tag, a)).alias("type"), a.alias("start"), b.alias("stop")
                ),
            )

        return let(F.transform(tag, opens), between)

    return let(F.transform(col(tags), lambda t: F.coalesce(t, F.lit(OUTSIDE))), spans)


def tag_histogram(tags: Column | str, keep: list[str] | None = None) -> Column:
    """``map<tag,count>`` of one row's tags, restricted to ``keep``; empty for null."""
    counted = lambda t: t.isNotNull() if keep is None else t.isin(keep)

    def entries(kept: Column) -> Column:
        return F.transform(
            F.array_distinct(kept),
            lambda t: F.struct(t, F.size(F.filter(kept, lambda u: u == t)).cast("long")),
        )

    kept = F.coalesce(F.filter(col(tags), counted), no_strings())
    return F.map_from_entries(let(kept, entries))


def first_per_key(entries: Column) -> Column:
    """Of structs ``key``, ``place``, … the one with the least place for each key, in order of the keys."""
    return let(
        F.sort_array(entries),
        lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["key"] != e["key"])),
    )


def first_subword_labels(
    word_ids: Column | str, tags: Column | str, n: Column | int, default: str = OUTSIDE
) -> Column:
    """One label per word: that of the word's first sub-token; words with none get the default.

    Sub-tokens and a default for every word are sorted by word and place, and the first of each word
    is kept: the cost grows as the length of the row, times its logarithm."""
    n = F.lit(n) if isinstance(n, int) else n

    def labels(given: Column) -> Column:
        ids = F.coalesce(given["ids"], F.array().cast("array<int>"))
        known = F.transform(
            ids, lambda w, i: F.struct(w.cast("int").alias("key"), i.alias("place"), F.get(given["tags"], i).alias("label"))
        )
        inside = F.filter(known, lambda e: (e["key"] >= 0) & (e["key"] < given["n"]))
        plain = F.transform(
            F.sequence(F.lit(0), given["n"] - 1),
            lambda w: F.struct(w.alias("key"), F.size(ids).alias("place"), F.lit(default).alias("label")),
        )
        kept = first_per_key(F.concat(inside, plain))
        return F.transform(kept, lambda e: F.coalesce(e["label"], F.lit(default)))

    given = F.struct(col(word_ids).alias("ids"), col(tags).alias("tags"), n.cast("int").alias("n"))
    return F.when(n > 0, let(given, labels)).otherwise(no_strings())


def _bare(piece: Column) -> Column:
    return F.replace(F.replace(piece, F.lit("##"), F.lit("")), F.lit("Ġ"), F.lit(""))


def densify_labels(pieces: Column | str, entities: Column | str) -> Column:
    """One label per piece from sparse ``array<struct<index,word,entity>>`` output. ``index`` counts
    from 1; the entity lands on that piece or the next, on the first that ends with its word; of two
    on one piece the later wins."""

    def labels(piece: Column) -> Column:
        def landing(e: Column, j: Column) -> Column:
            word = F.replace(e["word"], F.lit("##"), F.lit(""))
            at = e["index"].cast("int") - 1
            place = F.when(F.endswith(F.get(piece, at), word), at).when(
                F.endswith(F.get(piece, at + 1), word), at + 1
            )
            return F.struct(place.alias("key"), (-j).alias("place"), e["entity"].alias("label"))

        none = F.array().cast("array<struct<key:int,place:int,label:string>>")
        landed = F.coalesce(F.transform(col(entities), landing), none)
        found = F.filter(landed, lambda e: e["key"].isNotNull())
        outside = F.transform(
            positions(piece), lambda i: F.struct(i.alias("key"), F.lit(1).alias("place"), F.lit(OUTSIDE).alias("label"))
        )
        kept = first_per_key(F.concat(found, outside))
        return F.transform(kept, lambda e: F.coalesce(e["label"], F.lit(OUTSIDE)))

    return let(col(pieces), labels)


def align_tokens(actual: Column | str, pieces: Column | str, labels: Column | str) -> Column:
    """Labels for ``actual`` words from the labels of sub-word ``pieces``, glued greedily: a word is
    labelled by the piece that completes it, and ``O`` when the glued text departs from it; the
    departing piece is tried on the next word, the ones before it are spent. Null arrays give null; a
    null word is ``O``, a null piece completes no word.

    Where the pieces spell the words, the ends of both are sorted lists of running lengths, and a word's
    piece is found by its end, for all rows of a batch at once. Other rows are glued piece by piece from
    the first word whose end is no end of a piece. Either way the work is linear in words and pieces."""
    bare = F.transform(col(pieces), _bare)
    found = F.arrow_udf(_aligned, "array<string>").asNondeterministic()  # keeps it out of lambdas
    return found(col(actual), bare, col(labels))


def _aligned(words: pa.Array, parts: pa.Array, labels: pa.Array) -> pa.Array:
    valid = np.all([pc.is_valid(x).to_numpy(zero_copy_only=False) for x in (words, parts, labels)], axis=0)
    word, part = _Ends(words), _Ends(parts)
    tags, n_tags = labels.flatten(), _lengths(labels)
    tag_first = np.cumsum(n_tags) - n_tags
    plain = word.plain & part.plain
    # the rows one behind the other, each with room for the longer of both texts
    room = np.maximum(word.size, part.size) + 1
    base = np.cumsum(room) - room
    cuts = base[part.row] + part.stop
    stops = base[word.row] + word.stop
    at = np.searchsorted(cuts, stops)
    fits = at < len(cuts)
    fits[fits] = cuts[at[fits]] == stops[fits]
    fits &= plain[word.row] & (word.stop <= _common(word, part, plain)[word.row])
    spelt = _first(np.flatnonzero(~fits) - word.first[word.row[~fits]], word.row[~fits], word.count)  # words up to the first that does not fit
    nth = np.arange(len(word.row)) - word.first[word.row]
    good = nth < spelt[word.row]
    place = at - part.first[word.row] if len(word.row) else at
    index = np.where(good & (place < n_tags[word.row]), tag_first[word.row] + place, -1)
    # the others are glued piece by piece
    hurt = valid & (spelt < word.count)
    glued: list[str | None] = []
    if hurt.any():
        picked = pa.array(hurt)
        lists = [_lists(x.filter(picked)) for x in (words, parts, labels)]
        for r, w, p, t in zip(np.flatnonzero(hurt).tolist(), *lists):
            first = int(spelt[r])
            used = int(place[word.first[r] + first - 1]) + 1 if first else 0
            glued += _glued(w[first:], p, t, used)
        index[hurt[word.row] & ~good] = len(tags) + np.arange(len(glued))
    values = pa.concat_arrays([tags.cast(pa.string()), pa.array(glued, pa.string())])
    kept = index[valid[word.row]]
    found = values.take(pa.array(kept, mask=kept < 0))
    ends = np.append(0, np.cumsum(np.where(valid, word.count, 0))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), found, mask=pa.array(~valid))


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(lists: pa.Array) -> Iterator[list[str | None]]:
    values, end = lists.flatten().to_pylist(), 0
    for n in _lengths(lists).tolist():
        yield values[end:end + n]
        end += n


def _first(places: np.ndarray, rows: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    """Of each row the first of its places, which are in order; ``otherwise`` where it has none."""
    out = otherwise.copy()
    new = np.diff(rows, prepend=-1) != 0
    out[rows[new]] = places[new]
    return out


class _Ends:
    """Lists of strings, flat: the ``row`` of each string and where it ends in all strings of its row put together. ``plain``: rows
    with strings, none of them null or empty, as their ends tell them apart."""

    def __init__(self, lists: pa.Array) -> None:
        flat = lists.flatten().cast(pa.string()).fill_null("")
        _, offsets, data = flat.buffers()
        stops = np.frombuffer(offsets, np.int32)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data or b"", np.uint8)
        self.count = _lengths(lists)
        last = np.cumsum(self.count)
        self.first = last - self.count
        self.row = np.repeat(np.arange(len(lists)), self.count)
        self.start, self.size = stops[self.first], stops[last] - stops[self.first]
        self.stop = stops[1:] - self.start[self.row]
        empty = np.append(0, np.cumsum(np.diff(stops) == 0))
        self.plain = (self.count > 0) & (empty[last] == empty[self.first])


def _common(one: _Ends, other: _Ends, plain: np.ndarray) -> np.ndarray:
    """How many bytes the texts of each plain row share from the start."""
    n = np.where(plain, np.minimum(one.size, other.size), 0)
    row = np.repeat(np.arange(len(n)), n)
    byte = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    differ = np.flatnonzero(one.data[one.start[row] + byte] != other.data[other.start[row] + byte])
    return _first(byte[differ], row[differ], n)


def _glued(words: list[str | None], parts: list[str | None], tags: list[str], used: int) -> list[str | None]:
    out = []
    for word in words:
        label, done = OUTSIDE, 0
        while used < len(parts) and word is not None and parts[used] is not None and word.startswith(parts[used], done):
            done, used = done + len(parts[used]), used + 1
            if done == len(word):
                label = tags[used - 1] if used <= len(tags) else None
                break
        out.append(label)
    return out


def merge_entities(words: Column | str, labels: Column | str) -> Column:
    """``array<struct<text,label>>``: each ``B-`` word with the ``I-`` words up to the next ``B-``
    glued on (``##`` dropped). ``O`` does not end an entity; an ``I-`` before any ``B-`` is dropped."""
    spelt_out = _literal_map(SPELT_OUT)

    def merge(given: Column) -> Column:
        word, label = given["words"], given["labels"]

        def merged(start: Column, end: Column) -> Column:
            tail = F.filter(
                F.sequence(start, end - 1),
                lambda i: (i > start) & F.startswith(F.get(label, i), F.lit("I-")),
            )
            glued = F.array_join(
                F.transform(tail, lambda i: F.replace(F.get(word, i), F.lit("##"), F.lit(""))), ""
            )
            kind = F.upper(F.replace(F.get(label, start), F.lit("B-"), F.lit("")))
            return F.struct(
                F.concat(F.get(word, start), glued).alias("text"),
                F.coalesce(F.try_element_at(spelt_out, kind), kind).alias("label"),
            )

        def between(starts: Column) -> Column:
            later = F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1)))
            ends = F.concat(later, F.array(F.size(label)))
            return F.when(F.size(starts) > 0, F.zip_with(starts, ends, merged)).otherwise(
                F.array().cast("array<struct<text:string,label:string>>")
            )

        starts = F.filter(
            positions(label), lambda i: F.startswith(F.get(label, i), F.lit("B-"))
        )
        return let(starts, between)

    return let(F.struct(col(words).alias("words"), col(labels).alias("labels")), merge)

