"""Texts cut off before their end, found from word trigrams in SQL.

Every text is split into words; numbers, links and capitalised words stand for
their class, and no trigram crosses a sentence's start. Of each word trigram it
is counted how often it stands inside a sentence and how often at an end; where
a last trigram is too rare to tell, its last two words decide, then its last. A text whose last trigram is frequent inside
but almost never terminal was cut; so was one whose last word is a beginning of
the words that usually follow the two before it. Ends that say so themselves
(ellipses, marks, half characters) and lengths at which a source's unfinished
texts pile up are counted as cuts, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import scratch, write_table

#: A trigram is frequent inside from this many occurrences.
MIN_INSIDE = 4
#: ... and almost never terminal if no more than this share of its occurrences ends a sentence.
MAX_TERMINAL = 0.05
#: A length is a field limit if so many unfinished texts of a source have exactly it,
LIMIT_TEXTS = 8
#: ... this many times the mean of the ten lengths on either side.
LIMIT_PEAK = 8.0
#: Texts of fewer words are placeholders or labels, never cut texts.
MIN_WORDS = 4

# Endings that state a cut.
_MARKS = r"""(?:…|\.\.\.|&hellip;|&#8230;|\x{FFFD}|[\[(]\s*(?:…|\.{3}|(?:\.{3}|…)?\s*(?:truncated|more|read more|continued|cut|abridged|snip))\s*[\])]|&[#a-zA-Z0-9]{0,7})$"""
_PATTERNS = {
    "marks": _MARKS,
    "front": r"^(?:…|\.\.\.|&hellip;|\[(?:…|\.\.\.)\])",
    "closers": """"'”’»)]""",
    # A full stop after a digit may be the point of a number that was cut.
    "point": r"[0-9]\.$",
    "open": r"[,;:(\[/–—-]$",
    # Any run of white space but a single blank, which stays as it is.
    "space": r" ?[\s\u00A0&&[^ ]][\s\u00A0]*|  [\s\u00A0]*",
    "tail": 32,
}

_TEXTS = """
SELECT src, body, char_length(body) AS len
FROM (SELECT source AS src, rtrim(regexp_replace(body, :space, ' ')) AS body FROM {rows}) GROUP BY src, body
"""

# The words of a text, with classes in place of numbers, links and names, and two marks before every sentence.
# Whole-text replacements and array access stay in generated code; no word is looked at twice. A pattern starts with
# a character of its own, and looks behind only there: what is tried at
# every place of a text takes most of the time.
_START, _NAME, _LINK = "\uE000", "\uE001", "\uE002"


def _written(body: str) -> str:
    steps = [
        (r"""([.?!][)\]}"'”’»]*) """, f"$1 {_START} {_START} "),
        (r"""(?![a-z ])(?:[.!?)\]}"'”’»]+(?= |$)|[(\[{"'“‘«](?<=(?: |^).)[(\[{"'“‘«]*)""", ""),
        (r"[0-9](?<=(?: |^).)[^ ]*", "#"),
        (r"http(?<=(?: |^)http)s?://[^/ ]+\.[a-z]+(?:/[^ ]*)?(?= |$)", _LINK),
        (rf" (?<!{_START} )\p{{Lu}}[^ ]*", f" {_NAME}"),
    ]
    out = f"concat('{_START} {_START} ', ltrim({body}))"
    for i, _ in enumerate(steps):
        out = f"regexp_replace({out}, :find{i}, :put{i})"
        _PATTERNS[f"find{i}"], _PATTERNS[f"put{i}"] = steps[i]
    return f"lower({out})"


def _tokens(body: str) -> str:
    return f"split({_written(body)}, ' ')"


# No trigram crosses a sentence's start, so a sentence that many texts have is taken apart once.
_THREE = f"""
SELECT c1, c2, c3, sum(CASE WHEN at_end THEN 0 ELSE n END) AS inside, sum(CASE WHEN at_end THEN n ELSE 0 END) AS terminal
FROM (
  SELECT coalesce(get(ws, i - 2), '{_START}') AS c1, coalesce(get(ws, i - 1), '{_START}') AS c2, c3, get(ws, i + 1) IS NULL AS at_end, n
  FROM (
    SELECT split(sentence, ' ') AS ws, count(*) AS n
    FROM {{texts}} LATERAL VIEW explode(split(substr({_written("body")}, 5), ' {_START} {_START} ')) AS sentence GROUP BY sentence
  ) LATERAL VIEW posexplode(ws) AS i, c3
) GROUP BY c1, c2, c3
"""

# The last trigram needs four words: the one before it tells where a sentence starts. No mark is longer than the tail.
_ENDS = f"""
SELECT src, body, len, element_at(ws, -3) AS c1, element_at(ws, -2) AS c2, element_at(ws, -1) AS c3,
  right(body, :tail) RLIKE :marks OR left(body, :tail) RLIKE :front AS marked, right(trim(TRAILING :closers FROM body), 1) IN ('.', '!', '?') AS done,
  right(body, 2) RLIKE :point AS point, right(body, 1) RLIKE :open AS open
FROM (
  SELECT src, body, len, {_tokens("substring_index(body, ' ', -4)")} AS ws
  FROM {{texts}} WHERE char_length(body) - char_length(replace(ltrim(body), ' ', '')) + 1 >= :min_words
)
"""

# A context's words are counted by each of their beginnings, so that a fragment finds the longer words by equality
# and no frequent context meets all its ends in one task.
_CUT = f"""
WITH doubtful AS (
  SELECT * FROM {{ends}} WHERE NOT marked AND (NOT done OR point)
), contexts AS (
  SELECT 3 AS ord, c1 AS k1, c2 AS k2, c3, inside, terminal FROM {{three}}
  UNION ALL
  SELECT 2, '', c2, c3, sum(inside), sum(terminal) FROM {{three}} GROUP BY c2, c3
  UNION ALL
  SELECT 1, '', '', c3, sum(inside), sum(terminal) FROM {{three}} GROUP BY c3
), beginnings AS (
  SELECT ord, k1, k2, left(c3, k) AS c3,
    sum(CASE WHEN k = char_length(c3) THEN inside ELSE 0 END) AS inside, sum(CASE WHEN k = char_length(c3) THEN terminal ELSE 0 END) AS terminal,
    sum(CASE WHEN k = char_length(c3) THEN 0 ELSE inside + terminal END) AS longer
  FROM contexts LATERAL VIEW explode(sequence(1, greatest(char_length(c3), 1))) AS k GROUP BY 1, 2, 3, 4
), last_tri AS (
  SELECT c1, c2, c3 FROM doubtful GROUP BY c1, c2, c3
), asked AS (
  SELECT c1, c2, c3, q.* FROM last_tri
  LATERAL VIEW inline(array(struct(3 AS ord, c1 AS k1, c2 AS k2), struct(2 AS ord, '' AS k1, c2 AS k2), struct(1 AS ord, '' AS k1, '' AS k2))) q AS ord, k1, k2
), rated AS (
  -- The longest context that was seen often enough decides.
  SELECT a.c1, a.c2, a.c3, max_by(named_struct('inside', inside, 'terminal', terminal, 'longer', longer), ord) AS r
  FROM asked a JOIN beginnings b USING (ord, k1, k2, c3)
  WHERE inside + terminal + longer >= :min_inside GROUP BY a.c1, a.c2, a.c3
), lengths AS (
  SELECT src, len, count(*) AS texts FROM doubtful WHERE NOT done GROUP BY src, len
), limits AS (
  SELECT src, len FROM (
    SELECT src, len, texts, sum(texts) OVER (PARTITION BY src ORDER BY len RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) - texts AS around FROM lengths
  ) WHERE texts >= :limit_texts AND texts >= :limit_peak * around / 20.0
)
SELECT src, xxhash64(body) AS hash, len FROM {{ends}} WHERE marked
UNION ALL
SELECT d.src, xxhash64(d.body), d.len FROM doubtful d
LEFT JOIN rated r ON d.c1 = r.c1 AND d.c2 = r.c2 AND d.c3 = r.c3
LEFT JOIN limits m ON d.src <=> m.src AND d.len = m.len
WHERE d.open
  OR r.r.inside >= :min_inside AND r.r.terminal <= :max_terminal * (r.r.inside + r.r.terminal)
  OR d.c3 NOT IN ('#', '{_NAME}', '{_LINK}') AND r.r.longer >= :min_inside AND r.r.inside + r.r.terminal <= :max_terminal * r.r.longer
  OR m.len IS NOT NULL AND NOT d.done
"""


def cut_texts(rows: DataFrame, text: str = "abstract") -> DataFrame:
    """``source, hash, len``: the distinct whitespace-tidied texts of each source that were cut, by hash and length.

    ``rows`` has ``source`` and the text column. Null and blank texts and texts of
    fewer than ``MIN_WORDS`` words are never cut. Counts cover all distinct texts.
    """
    have = rows.where(F.col(text).isNotNull()).select("source", F.col(text).alias("body"))
    args = _PATTERNS | {"min_words": MIN_WORDS, "limit_texts": LIMIT_TEXTS, "limit_peak": LIMIT_PEAK, "min_inside": MIN_INSIDE, "max_terminal": MAX_TERMINAL}
    spark = have.sparkSession
    # All are read several times: they are tables of their own in the shared folder.
    texts = write_table(spark.sql(_TEXTS, args=args, rows=have), scratch(spark, "texts"))
    three = write_table(spark.sql(_THREE, args=args, texts=texts), scratch(spark, "trigrams"))
    ends = spark.sql(_ENDS, args=args, texts=texts)
    # Most texts end as they should: only the others are kept.
    ends = write_table(ends.where("marked OR NOT done OR point"), scratch(spark, "ends"))
    return spark.sql(_CUT, args=args, ends=ends, three=three).withColumnRenamed("src", "source")


def flag_cut(rows: DataFrame, text: str = "abstract", flag: str = "is_cut") -> DataFrame:
    """``rows`` with a boolean ``flag``: whether the text was cut off."""
    tidy = F.rtrim(F.regexp_replace(text, _PATTERNS["space"], " "))
    cut = cut_texts(rows, text).select(F.col("source").alias("__src"), F.col("hash").alias("__h"), F.col("len").alias("__len")).distinct()
    j = rows.withColumn("__tidy", tidy).withColumn("__k", F.xxhash64("__tidy")).withColumn("__n", F.length("__tidy")).drop("__tidy")
    j = j.join(cut, (F.col("__k") == F.col("__h")) & (F.col("__n") == F.col("__len")) & F.col("source").eqNullSafe(F.col("__src")), "left")
    return j.select(*[rows[c] for c in rows.columns], F.col("__len").isNotNull().alias(flag))


def cut_share(rows: DataFrame, text: str = "abstract") -> DataFrame:
    """``source, texts, cut, share``: how often each source's texts were cut; nulls and blanks are no texts."""
    have = flag_cut(rows.where(F.trim(F.col(text)) != ""), text)
    return have.groupBy("source").agg(F.count("*").alias("texts"), F.count_if("is_cut").alias("cut")).withColumn("share", F.col("cut") / F.col("texts"))
