"""Spelling variants by the frontier of a relational trie.

Words at one insertion, deletion or replacement of each other are found by walking a trie as joins: states (word, position,
node, edits) meet a distributed table of edges at their node, all words a level at a time, and what has made one edit and ends
with its word is a neighbour.

* A word is half right: an edit lies behind its first half, or before its last one. So words walk two tries, one of the
  words and one of the words reversed, and each starts below its own first half, where few words still share a node.
* Nodes are prefixes (by a hash); only those are kept where words part. An edge holds the letters up to the next such
  node, so the number of levels depends on how often words part and not on their length.
* A state without edits stands at a node of its own word and edits where an edge leaves it: the edge's first letter is
  inserted, or replaces a smaller one. The pair is found from the shorter word, or from the one with the smaller letter, and counts
  for both. A state with an edit follows its word's own letters. An edge knows the first letters behind its end, and a few hundred bits
  of hashes of all that lies below it, so most states that would end further down aren't made.
* A node that more than ``CROWD`` words share has its edges (one for each letter) copied to several parts, and the words that pass are dealt to them.

Neighbours are confirmed by their edit distance, as hashes of prefixes might agree by chance; such a chance adds paths and hides none.

A null text has no words, a null id no struck letters. Empty texts and tables give no words. Ties between forms go to the smaller word in
code-point order. A word of 100,000 letters costs as many prefixes, but no more levels. Repeated rows count each time; other columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import remove, scratch, stored

LETTER = "[A-Za-zÀ-ÿ]"
#: A word has so many letters and occurrences at least, and its form at least so many times its own.
LETTERS, OCCURRENCES, RATIO = 7, 2, 10
#: Words that pass a node in one part of it.
CROWD = 20_000
#: Numbers of 64 bits each that sum up the ends of words below a node.
SUMS = 4


def lowered(text: Column) -> Column:
    """Lower case of A to Z only."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def struck(run: Column, number: Column, every: int) -> Column:
    """The run without one code point, at ``number`` modulo its length, where ``every`` divides the number."""
    at = (number % F.length(run)).cast("int")
    return F.when(number % every == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, letters: int = LETTERS, occurrences: int = OCCURRENCES, strike: int | None = None) -> DataFrame:
    """``word, n``: runs of letters with at least ``letters`` of them that occur at least ``occurrences`` times.

    With ``strike`` every so many-th run, by the checksum of its document and itself, loses a letter: planted misspellings.
    """
    # the outer form of explode spares a filter on the number of runs, for which the pattern would run twice
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode_outer(F.regexp_extract_all(F.col(text_col), F.lit(f"(?<!{LETTER}){LETTER}{{{letters},}}+"), F.lit(0))).alias("run"))
    word = run = lowered(F.col("run"))
    if strike:
        runs = runs.select("id", run.alias("run")).select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("number"))
        word = struck(F.col("run"), F.col("number"), strike)
    found = runs.select(word.alias("word")).where(F.length("word") >= letters)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def _letter(text: Column, at: Column) -> Column:
    """The code point at a place (from 0), 0 behind the end."""
    return F.ascii(text.substr(at + 1, F.lit(1)))


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), letter % 64)


def _sum_bit(number: Column) -> Column:
    """The bit that a hash has in the number of its turn."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))


def _turn(number: Column) -> Column:
    """Which of the numbers that sum up a node has the bit of a hash."""
    return F.pmod(F.shiftright(number, 6), F.lit(SUMS))


def _tries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and paths of both tries, for words read from the front (``way`` 0) and from the back (1).

    ``node, letters, below0 ..., parts``: prefixes behind which words part, with the letters and the ends that follow.
    ``way, text, n, path, skip``: each word's nodes (depth, node, parts) from half of it on, and how many come before the half.
    """
    read = words.select(F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("text")), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("text")))).alias("r"), "n")
    text, depth = F.col("text"), F.col("depth")
    steps = read.select("r.way", "r.text", "n").withColumn("depth", F.explode_outer(F.expr("sequence((length(text) - 1) div 2, length(text))")))
    steps = steps.withColumn("depth", depth.cast("int")).withColumn("node", F.xxhash64("way", text.substr(F.lit(1), depth)))
    behind = steps.select("node", text.substr(depth + 1, F.length(text)).alias("rest")).select("node", F.ascii("rest").alias("letter"), F.xxhash64("rest").alias("number"))
    behind = behind.select("node", "letter", _turn(F.col("number")).alias("turn"), _sum_bit(F.col("number")).alias("bit"))
    sums = [f"below{i}" for i in range(SUMS)]
    nodes = behind.groupBy("node").agg(F.min("letter").alias("least"), F.max("letter").alias("most"), F.bit_or(_bit(F.col("letter"))).alias("letters"),
                                       F.count(F.lit(1)).alias("words"), *(F.bit_or(F.when(F.col("turn") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(name) for i, name in enumerate(sums)))
    nodes = stored(nodes.where("least < most").select("node", "letters", F.ceil(F.col("words") / CROWD).cast("int").alias("parts"), *sums), "spelling_nodes")
    found = steps.join(nodes.select("node", "parts"), "node").groupBy("way", "text", "n").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "parts"))).alias("path"))
    # the words as they are keep their first half, the reversed ones their last
    half = F.expr("if(way = 0, length(text) div 2, length(text) - length(text) div 2)")
    return nodes, stored(found.withColumn("skip", F.size(F.filter("path", lambda p: p["depth"] < half))), "spelling_paths")


def _edges(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, part, first, tail, child, child_parts, letters, below0 ..., target, target_n``: down to the next node, or to the end of a word.

    The label is its ``first`` letter and its ``tail``; bits of the letters that may come after the first (``second``) and after the last (``letters``).
    """
    hop = F.explode_outer(F.expr("transform(path, (p, i) -> struct(p as at, get(path, i + 1) as next))")).alias("hop")
    down = paths.select("text", "n", hop).select(
        F.col("hop.at.node").alias("node"), F.col("hop.at.parts").alias("parts"),
        F.col("text").substr(F.col("hop.at.depth") + 1, F.coalesce(F.col("hop.next.depth") - F.col("hop.at.depth"), F.length("text"))).alias("label"),
        F.col("hop.next.node").alias("child"), F.when(F.col("hop.next").isNull(), F.col("text")).alias("target"), F.when(F.col("hop.next").isNull(), F.col("n")).alias("target_n"))
    ends = nodes.select(F.col("node").alias("below"), F.col("parts").alias("child_parts"), "letters", *(f"below{i}" for i in range(SUMS)))
    whole = down.distinct().join(ends, F.col("child") == F.col("below"), "left").drop("below").withColumn("letters", F.coalesce("letters", F.lit(1)))
    second = F.when(F.length("label") > 1, _bit(_letter(F.col("label"), F.lit(1)))).otherwise(F.col("letters"))
    own = {"first": F.ascii("label"), "second": second, "tail": F.expr("substring(label, 2)")}
    return whole.withColumns(own).withColumn("part", F.explode_outer(F.expr("sequence(0, parts - 1)"))).drop("parts", "label")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: states meet the edges of their nodes; the rows that have made an edit and go on, or have ended (``target``).

    A state offers two moves. It stays where it is in its word while the edge's first letter is inserted (``late`` 0), or passes a letter, which the
    edge's first one replaces or, after an edit, equals (1). Single letters are compared first, as bits; tails and texts for what is left.
    The generated code of a level must stay short, or the JVM won't compile it: what depends on the state alone is reckoned before the join.
    """
    text, at, own, edited = F.col("text"), F.col("at"), F.col("own"), F.col("edits") == 1
    none, least, most = F.lit(0).cast("long"), F.lit(1), F.lit(0x110000)
    dealt = states.withColumns({"own": _letter(text, at), "ahead": _letter(text, at + 1), "part": F.pmod(F.xxhash64("text"), F.col("parts")).cast("int")})
    dealt = dealt.select("way", "text", "n", "at", "node", "part", "own",
                         F.when(edited, own).when(own == 0, most).otherwise(own + least).alias("low"), F.when(edited, own).otherwise(most).alias("high"),
                         F.when(edited, none).otherwise(_bit(own)).alias("inserts"), F.when(edited, F.lit(-1).cast("long")).otherwise(_bit(F.col("ahead"))).alias("passes"))
    first, second = F.col("first"), F.col("second")
    stays = (first > 0) & (first != own) & (second.bitwiseAND(F.col("inserts")) != 0)
    moves = first.between(F.col("low"), F.col("high")) & (second.bitwiseAND(F.col("passes")) != 0)
    met = dealt.join(edges, (dealt["node"] == edges["node"]) & (dealt["part"] == edges["part"]) & (stays | moves)).drop("node", "part")
    late = F.col("late")
    start, size = at + late, F.length("tail")
    gone = met.withColumn("late", F.explode(F.array(F.lit(0), F.lit(1)))).where(F.when(late == 0, stays).otherwise(moves) & (text.substr(start + 1, size) == F.col("tail")))
    gone = gone.select("way", "text", "n", F.when(first == 0, at).otherwise(start + size).alias("at"), "child", "child_parts", "letters", *(f"below{i}" for i in range(SUMS)), "target", "target_n")
    gone = gone.withColumn("rest", text.substr(at + 1, F.length(text)))
    ended = F.col("target").isNotNull() & (F.col("rest") == "")
    on = gone.where(ended | (F.col("target").isNull() & (F.col("letters").bitwiseAND(_bit(F.ascii("rest"))) != 0))).withColumn("number", F.xxhash64("rest"))
    turn = _turn(F.col("number"))
    below = F.col("below0")
    for i in range(1, SUMS):
        below = F.when(turn == i, F.col(f"below{i}")).otherwise(below)
    found = F.col("target").isNotNull()
    on = on.where(found | (below.bitwiseAND(_sum_bit(F.col("number"))) != 0))
    return on.select("way", "text", "n", "at", F.col("child").alias("node"), F.col("child_parts").alias("parts"), "target", "target_n", found.alias("found"))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: each pair of words at one edit once. ``words`` (``word, n``) must be a written table of distinct words."""
    spark = words.sparkSession
    nodes, paths = _tries(words)
    edges = stored(_edges(nodes, paths), "spelling_edges")
    deepest = paths.agg(F.max(F.size("path") - F.col("skip"))).head()[0] or 0
    kinds = "way int, text string, n long, at int, node long, parts int, target string, target_n long, found boolean"
    frontier, found, level, left = None, [], 0, None
    while level < deepest or left is not None:
        own = F.expr(f"get(path, skip + {level})")
        states = paths.where(F.size("path") > F.col("skip") + level).select("way", "text", "n", own["depth"].alias("at"), own["node"].alias("node"), own["parts"].alias("parts"), F.lit(0).alias("edits"))
        if frontier is not None:
            states = states.union(frontier)
        place = scratch(spark, "spelling_frontier")
        _step(states, edges).write.partitionBy("found").parquet(place)
        if left is not None:
            remove(spark, f"{left}/found=false")  # the states of the level before
        done = spark.read.schema(kinds).parquet(place)
        found.append(done.where("found").select("way", "text", "n", "target", "target_n"))
        frontier = done.where("not found").select("way", "text", "n", "at", "node", "parts", F.lit(1).alias("edits"))
        left = None if frontier.isEmpty() else place
        frontier = None if left is None else frontier
        level += 1
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).where(F.lit(False))
    ended = found[0]
    for more in found[1:]:
        ended = ended.union(more)
    turned = [F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)) for c in ("text", "target")]
    pairs = ended.select("way", turned[0].alias("word"), "n", turned[1].alias("other"), F.col("target_n").alias("other_n"))
    # what shares the first half has been found by the words as they are
    half = F.expr("way = 0 or substring(word, 1, length(word) div 2) != substring(other, 1, length(word) div 2)")
    return pairs.where(half & (F.levenshtein("word", "other", 1) == 1)).drop("way")


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``word, form, form_n, root``: where forms of forms end. A form has ``ratio`` times the occurrences, so chains are short: their links are doubled."""
    found = stored(forms.withColumn("root", F.col("form")), "spelling_forms")
    chain = max(1.0, math.log(max(most, ratio)) / math.log(ratio))
    for _ in range(math.ceil(math.log2(chain)) + 1):
        step = found.select(F.col("word").alias("via"), F.col("root").alias("further"))
        found = found.join(step, F.col("root") == F.col("via"), "left").select("word", "form", "form_n", F.coalesce("further", "root").alias("root"))
    return found


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, letters: int = LETTERS, occurrences: int = OCCURRENCES, ratio: int = RATIO, strike: int | None = None) -> DataFrame:
    """Per word: n, n_near (words at one edit), form (the near word of largest n, if that is ``ratio`` times its own), form_n, root."""
    words = stored(vocabulary(docs, id_col, text_col, letters=letters, occurrences=occurrences, strike=strike), "spelling_words")
    pairs = stored(near_words(words), "spelling_pairs")
    sides = pairs.select(F.explode(F.array(F.col("word"), F.col("other"))).alias("word"))
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"))
    common = F.col("other_n") > F.col("n")
    rare = pairs.select(F.when(common, F.col("word")).otherwise(F.col("other")).alias("word"), F.least("n", "other_n").alias("n"),
                        F.when(common, F.col("other")).otherwise(F.col("word")).alias("form"), F.greatest("n", "other_n").alias("form_n")).where(F.col("form_n") >= ratio * F.col("n"))
    best = rare.groupBy("word").agg(F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    most = words.agg(F.max("n")).head()[0] or 0
    forms = _roots(best.select("word", "best.form", (-F.col("best.less")).alias("form_n")), most, ratio)
    return words.join(near, "word", "left").join(forms, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
