"""Spelling variants: words one edit apart, and the frequent word that each stands for.

Two words are near if one inserted, deleted or replaced code point makes one of the
other. Such an edit lies in some window of the shorter word's places; all before and
all after the window is equal in both. So words are dealt out by window: by the shorter
word's length, the window, and what stands outside of it. In each of these lists, in
the order of code points, every word is compared with the later ones by dynamic
programming over a band of three cells: two neighbours of the list share the rows of
their common prefix, and once a row has no cell of one edit or less, all words with that
prefix are passed over. A pair is counted in one list only, that of the window in which
the two words first differ.

A list that is too long is dealt out again by the halves of its window, and so on. In
the end a window is one place; such a list has at most as many words as there are ways
to fill one or two places with letters, so no task holds more, however many words share
a beginning or an end. No pair is left out, and none leaves a task: a list gives for
each of its words the number and the most frequent of its near words.

Null texts have no words, a null id counts as an empty one. Texts are counted row by
row, so repeated rows and ids count each time. A run of letters of any length is a
word. An empty table has no words. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .batches import small_batches

#: The letters of a word's runs.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Windows that a word's places are first cut into, and words from which a list is cut further.
WINDOWS, MOST = 4, 64
LIST = ["role", "lo", "hi", "rest"]
FOUND = "word string, n_near long, less long, form string"


def runs_of_letters(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): all maximal runs of at least `least` letters, A-Z made small, one row for each place."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    long = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    # `lower` also knows other capitals, so it serves ASCII alone.
    ascii_only = F.octet_length("run") == F.length("run")
    return long.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))


def thinned(run: Column, key: Column, every: int) -> Column:
    """The run, without one code point if `every` divides its key: the one at the key's remainder."""
    at = (key % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(key % every == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, least: int = 5, times: int = 3, every: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least `least` code points that occur at least `times` times."""
    runs = runs_of_letters(docs, least, id_col, text_col)
    key = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
    words = runs.select(thinned(F.col("run"), key, every).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def _rest() -> Column:
    """What stands outside of the window, for words of the role's length or one more."""
    after = F.expr("right(word, role - hi)")
    return F.xxhash64("role", "lo", "hi", F.expr("left(word, lo)"), after)


def _windows(words: DataFrame, windows: int) -> DataFrame:
    """Each word by each window, as the shorter word of a pair and as one that is a place longer."""
    roles = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("role")
    cut = words.select("word", "n", roles).where("role > 0").withColumn("wide", F.expr(f"(role + {windows - 1}) div {windows}").cast("int"))
    dealt = cut.withColumn("lo", F.explode(F.expr("sequence(0, role - 1, wide)")))
    return dealt.withColumn("hi", F.expr("least(role, lo + wide)")).withColumn("rest", _rest()).select(*LIST, "word", "n")


def _halves(lists: DataFrame) -> DataFrame:
    middle = F.expr("(lo + hi) div 2").cast("int")
    parts = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    cut = lists.select("role", F.explode(parts).alias("part"), "word", "n").select("role", "part.lo", "part.hi", "word", "n")
    return cut.withColumn("rest", _rest()).select(*LIST, "word", "n")


def lists(words: DataFrame, windows: int = WINDOWS, most: int = MOST) -> DataFrame:
    """(role, lo, hi, rest, word, n): the words of each list; lists of more than `most` words have windows of one place."""
    settled, left = [], _windows(words, windows)
    while True:
        sizes = left.groupBy(*LIST).agg(F.count("*").alias("size"))
        long = stage_table(sizes.where((F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)).select(*LIST), "long")
        if long.isEmpty():
            settled.append(left)
            break
        settled.append(left.join(long, LIST, "left_anti"))
        left = stage_table(_halves(left.join(long, LIST, "left_semi")), "halves")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def near_pairs(words: Sequence[str]) -> Iterator[tuple[int, int]]:
    """All (i, j), i < j, of words one edit apart in a list in the order of code points."""
    shared = [0, *(common_prefix(a, b) for a, b in zip(words, words[1:]))]
    for i, q in enumerate(words[:-1]):
        size, q = len(q), q + "\0\0"
        # rows[d]: edits from the first d letters of the list's word to the first d - 1, d, d + 1 of q; 2 is too many.
        depth = shared[i + 1]
        rows = [(2, 0, 1), *[(1, 0, 1)] * depth]
        j = i + 1
        while j < len(words):
            depth = min(depth, shared[j])
            del rows[depth + 1 :]
            word, (left, same, right) = words[j], rows[depth]
            j += 1
            for d in range(depth, len(word)):
                c = word[d]
                # d letters are done; q[d - 1], q[d], q[d + 1] end the three prefixes of the next row.
                a = min(left + (q[d - 1] != c), same + 1) if d else same + 1
                b = min(same + (q[d] != c) if d <= size else 2, right + 1, a + 1)
                right = min(right + (q[d + 1] != c) if d < size else 2, b + 1)
                left, same = a, b
                if a > 1 and b > 1 and right > 1:
                    while j < len(words) and shared[j] > d:
                        j += 1
                    depth = d
                    break
                rows.append((left, same, right))
            else:
                depth = len(word)
                off = size - depth
                if -1 <= off <= 1 and (left, same, right)[off + 1] == 1:
                    yield i, j - 1


def _best_of_list(role: int, lo: int, hi: int, words: list[str], n: list[int]) -> Iterator[tuple[str, int, int, str]]:
    found: dict[int, tuple[int, int, str]] = {}
    for i, j in near_pairs(words):
        a, b = words[i], words[j]
        if min(len(a), len(b)) != role:
            continue
        first = common_prefix(a, b)
        if not (lo <= first < hi or first == hi == role):
            continue
        for x, y in ((i, j), (j, i)):
            count, less, form = found.get(x, (0, 0, ""))
            best = min((less, form), (-n[y], words[y])) if count else (-n[y], words[y])
            found[x] = (count + 1, *best)
    for x, (count, less, form) in found.items():
        yield words[x], count, less, form


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and word; a list may go on in the next batch."""
    key, words, n = None, [], []
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("less", pa.int64()), ("form", pa.string())])

    def found():
        return _best_of_list(*key[:3], words, n) if len(words) > 1 else ()

    for batch in batches:
        out: list[tuple[str, int, int, str]] = []
        keys = zip(*[batch[c].to_pylist() for c in LIST])
        for now, word, times in zip(keys, batch["word"].to_pylist(), batch["n"].to_pylist()):
            if now != key:
                out += found()
                key, words, n = now, [], []
            words.append(word)
            n.append(times)
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if key is not None and (out := list(found())):
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def near_words(words: DataFrame, windows: int = WINDOWS, most: int = MOST) -> DataFrame:
    """(word, n_near, best_n, best) of ``words(word, n)``: near words, and the most frequent of them, the smallest among equals."""
    dealt = small_batches(lists(words, windows, most)).repartition(*[F.col(c) for c in LIST])
    found = dealt.sortWithinPartitions(*LIST, "word").mapInArrow(_scan, FOUND)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return best.select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``, one row per word that has a form: the end of its chain of forms.

    Every round doubles the part of a chain that a word has gone; a word that is at an
    end takes no part in later rounds. Forms occur at least twice as often as their words,
    so chains are short and have no circles.
    """
    known = forms.select(F.col("word").alias("form"), F.lit(True).alias("goes_on"))
    hops = forms.join(known, "form", "left").select("word", F.col("form").alias("at"), F.coalesce("goes_on", F.lit(False)).alias("goes_on"))
    hops = stage_table(hops, "hops")
    ended = [hops.where(~F.col("goes_on"))]
    while not (left := hops.where("goes_on")).isEmpty():
        ahead = hops.select(F.col("word").alias("at"), F.col("at").alias("next"), F.col("goes_on").alias("further"))
        moved = left.select("word", "at").join(ahead, "at").select("word", F.col("next").alias("at"), F.col("further").alias("goes_on"))
        moved = stage_table(moved, "hops")
        hops = _all([moved, *ended])
        ended.append(moved.where(~F.col("goes_on")))
    return _all(ended).select("word", F.col("at").alias("root"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def variants(words: DataFrame, windows: int = WINDOWS, most: int = MOST) -> DataFrame:
    """One row per word of ``words(word, n)``: word, form, root, n, n_near, form_n.

    The form is the most frequent near word if it occurs at least twice as often, else
    null; the root is where following forms ends, the word itself if it has none.
    """
    near = near_words(words, windows, most)
    takes = F.col("best_n") >= 2 * F.col("n")
    own = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best")).alias("form"),
        F.when(takes, F.col("best_n")).alias("form_n"),
    )
    own = stage_table(own, "forms")
    ends = roots(own.where("form is not null").select("word", "form"))
    return own.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    return variants(stage_table(vocabulary(docs), "vocabulary"))
