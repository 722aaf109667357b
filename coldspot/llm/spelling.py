"""Spelling variant grouping (operator 11): a dictionary of trie-node pairs.

1. Words are counted over all texts. Runs are cut, lower-cased and changed on the JVM and
   counted with map-side combination, so a word that fills a third of the corpus is one row
   per task before the shuffle.
2. The words are dealt into sorted ranges. Each task walks its range and numbers the nodes of
   the forward trie (a node is a prefix); prefixes that reach over a range's border are named
   by the border (see ``ranges``), so a prefix has one number everywhere. The reversed words
   give the numbers of the reversed trie (a node is a suffix) in the same way.
3. A word of L letters has the pair (prefix node, suffix node) around each of its L letters
   (a skipped position) and at each of its L + 1 gaps (an inserted position). Two words that
   share a pair by skipping differ by one replaced letter; a word whose skipped pair is
   another's gap has one letter more. As nodes are numbered exactly, so are the neighbours;
   nothing is confirmed afterwards. A letter next to an equal one can be left out at either
   place, so only the last of a run of equal letters counts as deleted: every near pair is
   met once.
4. The words of a pair differ in one letter at one place, so a pair has at most one word per
   letter of the alphabet. No pairs of words are listed: each word takes from its pair how
   many others there are and the best of them.
5. A word points to its form; pointers are followed by doubling on tables in the shared
   folder. Counts grow tenfold with each step, so a chain is short.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspot.llm.common import importable, stored
from coldspot.llm.duck import CRC32
from coldspot.llm.ranges import Shared, common_units, sorted_ranges

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
TYPO_MODULUS = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What a word is in a pair: whole (the pair is a gap in it), or with one letter skipped
# (the last of its run of equal letters, or another one).
GAP, LAST, OTHER = 0, 1, 2


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                typo_modulus: int = TYPO_MODULUS) -> DataFrame:
    """(word, n): maximal runs of letters of all texts, A-Z lower-cased. Where ``typo_modulus``
    divides h, the unsigned crc32 of ``<doc_id>:<run>``, the run loses its letter h % length.
    Only words of at least ``min_length`` letters and ``min_count`` occurrences. Null and
    empty texts have no runs; a null doc_id counts as the empty string; rows that repeat a
    doc_id count each."""
    # A letter is lost at most, so shorter runs never make a word.
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(
        F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("d", F.translate("run", _UPPER, _LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % typo_modulus == 0, lost).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


class NodeNumbers:
    """Numbers of the trie nodes on the paths of sorted words of one range. A number is
    positive and made of the partition, or negative and made of the border that names it."""

    def __init__(self, part: int, shared: Shared):
        self.base, self.made, self.shared = part << 40, 0, shared
        self.word, self.path = None, []

    def _new(self) -> int:
        self.made += 1
        return self.base | self.made

    def next(self, word: str) -> list[int]:
        """Numbers of the prefixes of ``word`` by length, the empty one first."""
        known = 0 if self.word is None else common_units(self.word, word) + 1
        path = self.path[:known]
        for depth in range(known, len(word) + 1):
            path.append(0)
        if known <= len(word):
            for border, owners in ((self.shared.head, self.shared.head_owner), (self.shared.tail, self.shared.tail_owner)):
                if border is not None:
                    for depth in range(known, common_units(border, word) + 1):
                        path[depth] = -(owners[depth] << 32 | depth) - 1
            for depth in range(known, len(word) + 1):
                if not path[depth]:
                    path[depth] = self._new()
        self.word, self.path = word, path
        return path


def _numbered(rows: DataFrame, shared: dict[int, Shared], extra: str) -> DataFrame:
    """Sorted rows (word, ...) with ``path``, the numbers of the word's prefixes. ``extra`` is
    the other columns' schema; ``id`` is made here if it is not among them (in word order)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    importable(rows.sparkSession)
    own = "id" not in rows.columns
    schema = extra + ", path array<long>" + (", id long" if own else "")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        part = TaskContext.get().partitionId()
        numbers, first = NodeNumbers(part, shared.get(part, Shared())), part << 40
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                paths = pa.array([numbers.next(w) for w in batch.column(0).to_pylist()], pa.list_(pa.int64()))
                columns = [*batch.columns[0 if own else 1:], paths]
                if own:
                    columns.append(pa.array(range(first, first + batch.num_rows), pa.int64()))
                    first += batch.num_rows
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def trie_paths(words: DataFrame) -> DataFrame:
    """Of distinct words (word, n): (id, word, n, path, back). ``path`` holds the numbers of
    the word's prefixes by length, ``back`` those of its suffixes; ``id`` grows with the word
    in code-point order."""
    rows, shared = sorted_ranges(words.select("word", "n"), "word")
    forward = stored(_numbered(rows, shared, "word string, n long"), "prefix-nodes")
    rows, shared = sorted_ranges(forward.select(F.reverse("word").alias("word"), "id"), "word")
    backward = _numbered(rows, shared, "id long").withColumnRenamed("path", "back")
    return forward.join(backward.hint("merge"), "id")


def node_pairs(paths: DataFrame) -> DataFrame:
    """(p, s, kind, id, n): the trie-node pairs of each word, see the module's text."""
    size = F.size("path")  # one more than the word's letters
    letters = F.split("word", "")

    def skipped(i):
        last = (i == size - 2) | (F.get("c", i) != F.get("c", i + 1))
        return F.struct(F.get("path", i).alias("p"), F.get("back", size - 2 - i).alias("s"),
                        F.when(last, F.lit(LAST)).otherwise(OTHER).cast("byte").alias("kind"))

    def gap(i):
        return F.struct(F.get("path", i).alias("p"), F.get("back", size - 1 - i).alias("s"), F.lit(GAP).cast("byte").alias("kind"))

    both = F.concat(F.transform(F.sequence(F.lit(0), size - 2), skipped), F.transform(F.sequence(F.lit(0), size - 1), gap))
    made = paths.where("length(word) > 0").withColumn("c", letters).select("id", "n", F.explode(both).alias("e"))
    return made.select("e.p", "e.s", "e.kind", "id", "n")


def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, n, n_near, best) of the words that have a near one; ``best`` is the near word of
    the largest n (ties: smallest id) as (n, -id)."""
    skip = F.col("kind") != GAP
    order = Window.partitionBy("p", "s").orderBy((~skip), F.desc("n"), "id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("id"))
    seen = pairs.select(
        "id", "n", "kind", me.alias("me"),
        F.sum(skip.cast("long")).over(whole).alias("skips"),
        F.sum((F.col("kind") == LAST).cast("long")).over(whole).alias("lasts"),
        F.max(F.when(~skip, me)).over(whole).alias("gap"),
        F.first(me).over(whole).alias("first"), F.nth_value(me, 2).over(whole).alias("second"),
        F.first(F.when(F.col("kind") == LAST, me), ignorenulls=True).over(whole).alias("best_last"))
    deleted = (F.col("kind") == LAST) & F.col("gap").isNotNull()
    near = F.when(~skip, F.col("lasts")).otherwise(F.col("skips") - 1 + deleted.cast("long"))
    replaced = F.when(F.col("skips") > 1, F.when(F.col("me") == F.col("first"), F.col("second")).otherwise(F.col("first")))
    best = F.when(~skip, F.col("best_last")).otherwise(F.greatest(replaced, F.when(deleted, F.col("gap"))))
    return (seen.select("id", "n", near.alias("near"), best.alias("best")).where("near > 0")
            .groupBy("id").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.max("best").alias("best")))


def last_of_chain(links: DataFrame) -> DataFrame:
    """Of links (id, form) without cycles: (id, root), the last of the chain from id."""
    ends = stored(links.select("id", F.col("form").alias("root")), "roots")
    while True:
        on = ends.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = stored(ends.join(on.hint("merge"), "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ends = new.select("id", "root")
        if new.where("moved").isEmpty():
            return ends


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n): see ``group``."""
    paths = stored(trie_paths(words), "trie-paths")
    near = stored(neighbours(node_pairs(paths)), "near-words")
    pointed = near.where(F.col("best.n") >= ratio * F.col("n")).select("id", (-F.col("best.id")).alias("form"), F.col("best.n").alias("form_n"))
    pointed = stored(pointed, "forms")
    roots = last_of_chain(pointed)
    names = paths.select("id", "word", "n")

    def named(rows, column):
        name = names.select(F.col("id").alias(column), F.col("word").alias(column + "_word"))
        return rows.hint("merge").join(name, column)

    told = named(named(pointed.join(roots.hint("merge"), "id"), "form"), "root").select(
        "id", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    return (names.join(near.select("id", "n_near").hint("merge"), "id", "left").join(told.hint("merge"), "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def group(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
          typo_modulus: int = TYPO_MODULUS) -> DataFrame:
    """Words of all texts with the common spelling they may be a variant of.

    Returns (word, form, root, n, n_near, form_n). Two words are near if they differ by one
    inserted, deleted or replaced letter; ``n_near`` counts a word's near words. ``form`` is
    the near word of the largest n (ties: the smallest in code-point order) if that n is at
    least ``ratio`` times the word's; else null, as is ``form_n``. ``root`` is the last word
    reached over forms, the word itself without one.

    Null and empty texts have no words, an empty table gives no rows, a text of any length is
    read whole, rows that repeat count each, a null doc_id counts as the empty string in the
    hash of ``word_counts``, other columns are ignored."""
    return variants(word_counts(docs, min_length, min_count, typo_modulus), ratio)


ORACLE_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
long_runs AS (SELECT d || ':' || run AS s, run FROM runs WHERE length(run) >= 7),
keys AS (SELECT DISTINCT s FROM long_runs),
""" + CRC32.strip() + r""",
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
  FROM long_runs JOIN crc32s USING (s)),
words AS (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
skipped AS (
  SELECT word, n, i, left(word, i) AS p, substring(word, i + 2) AS q
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n FROM skipped x JOIN skipped y ON x.p = y.p AND x.q = y.q AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM skipped x JOIN words y ON x.p || x.q = y.word
  UNION
  SELECT y.word, x.word, x.n FROM skipped x JOIN words y ON x.p || x.q = y.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS m FROM pairs GROUP BY a),
forms AS (SELECT a AS word, b AS form, m AS form_n FROM best JOIN words ON word = a WHERE m >= 10 * n),
chain AS (
  SELECT word, form AS root, 1 AS k FROM forms
  UNION ALL
  SELECT chain.word, forms.form, k + 1 FROM chain JOIN forms ON chain.root = forms.word),
roots AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN best ON a = word LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""
