"""Repair of text from scanned pages: page furniture, divided words and misread characters.

All of it is SQL over lines; nothing is gathered per paper.

* *Furniture*: lines at a page's edges whose shape (numbers as ``#``) comes again
  at the edges of the paper's other pages, or of other papers and hardly ever
  inside a page; lines that are close to such a shape; a header that the title
  under it continues; and numbers that count on with the pages.
* *Divided words*: the corpus vocabulary has the joined word rather than the
  compound with its own hyphen.
* *Misread words*: rare words that one confusion (one or two characters for one
  or two others) turns into a far more frequent word, by confusions that many
  words of the corpus show, and words with signs in the middle of letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import scratch, write_table

#: Lines at either edge of a page that may be furniture.
EDGE = 3
#: A shape is furniture if it stands on this share of a paper's pages, on at least two,
MIN_SHARE = 0.2
#: ... or on those of so many papers; at least this share of all its lines must be at an edge.
MIN_PAPERS = 3
AT_EDGE = 0.6
#: Share of a shape's characters that may differ.
FUZZY = 0.2
#: A misread word is at least so many times rarer than the right one.
RARER = 10
#: Different words that must show a confusion of letters.
CONFUSED_WORDS = 3
#: A misread word is at most so many times as frequent as the median of its confusion lets expect.
USUAL = 4

_ARGS = {
    "edge": EDGE, "min_share": MIN_SHARE, "min_papers": MIN_PAPERS, "at_edge": AT_EDGE, "fuzzy": FUZZY, "rarer": RARER, "confused": CONFUSED_WORDS, "usual": USUAL,
    "number": r"(?<![\p{L}\p{N}])[lIOSB|!]{0,3}[0-9][0-9lIOSB|!]*(?![\p{L}\p{N}])",
    "counter": r"^[^\p{L}#]*(?:(?:page|p\.|seite|s\.|página|pág\.)\s*)?#(?:\s*(?:of|/|von|de|sur)\s*#)?[^\p{L}#]*$",
    "authors": r"^(?:(?:\p{Lu}[\p{L}.'’-]*|d[aeiu]|del|van|von|der|al-\p{Lu}\p{L}+|[dO]['’]\p{L}+|et|al\.)[ ,;&]*)+$",
    "author_head": r"^(?:#\s+)?(?:\p{L}{1,3}\.\s*)+([\p{L}'’-]{3,})(?:\s+\p{L}{2}\s+\p{L}{2}\.?)?(?:\s+#)?$",
    "around": r"^[^\p{L}]*#[^\p{L}]+|[^\p{L}]+#[^\p{L}]*$",
    "fence": r"^\s*(?:`{3,}|~{3,})\s*\p{L}*\s*$",
    "hyphen": r"(\p{L}+)[-‐‑¬­]$",
    "first": r"^[(\[\"'“‘«]*(\p{L}+)",
    "inner": r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$",
    "sentence": r"[.?!:]['\"”’)\]]*$",
    "tail": r"([^\s\-‐‑]+)[-‐‑¬­]$",
    "head": r"^([^\s\-‐‑]+)",
    # Letters among the figures of a number.
    "numeral": r"^(?=.*[0-9])(?=.*[lisob|!])[0-9lisob|!]+(?:[.,][0-9lisob|!]+)*$",
    # A sign or figure between two letters; an apostrophe, point or hyphen is none.
    "odd": r"\p{L}[^\p{L}\s.,;:/&+'’()\[\]{}=~^_­‐‑–—-]\p{L}",
}

_LINES = """
WITH pages AS (
  SELECT page_id, coalesce(nullif(regexp_extract(page, '^(.*)/', 1), ''), concat('page ', page_id)) AS paper,
    try_cast(regexp_extract(page, '([0-9]+)[^0-9/]*$', 1) AS bigint) AS page_no,
    filter(transform(split(content, '\\n'), (x, i) -> struct(i + 1 AS line_no, x AS raw)), x -> x.raw RLIKE '[^\\\\s\\u00A0]' AND NOT x.raw RLIKE :fence) AS kept
  FROM {pages} WHERE page_id IS NOT NULL AND content IS NOT NULL
), lines AS (
  SELECT page_id, paper, page_no, size(kept) AS n, pos, line.line_no, line.raw, trim(get(kept, pos + 1).raw) AS below
  FROM pages LATERAL VIEW posexplode(kept) AS pos, line
)
SELECT page_id, paper, page_no, line_no, rtrim(raw) AS raw, trim(raw) AS text, pos + 1 AS from_top, n - pos AS from_bottom, below,
  lower(regexp_replace(trim(regexp_replace(raw, '[\\\\s\\u00A0]+', ' ')), :number, '#')) AS shape
FROM lines
"""

_FURNITURE = """
WITH edges AS (
  SELECT *, length(regexp_replace(shape, '[^\\\\p{{L}}]', '')) AS letters FROM {lines} WHERE from_top <= :edge OR from_bottom <= :edge
), papers AS (
  SELECT paper, count(DISTINCT page_id) AS pages FROM edges GROUP BY paper
), by_paper AS (
  SELECT paper, shape, max(letters) AS letters, count(DISTINCT page_id) AS pages FROM edges GROUP BY paper, shape
), everywhere AS (
  SELECT shape, count(*) AS n, count_if(from_top <= :edge OR from_bottom <= :edge) AS at_edge FROM {lines} GROUP BY shape
), papers_of AS (
  SELECT shape, count(*) AS papers FROM by_paper GROUP BY shape
), repeated AS (
  -- Over the collection first: what is furniture anywhere is furniture on a paper's only page, too.
  SELECT b.paper, b.shape FROM by_paper b JOIN papers p ON b.paper = p.paper JOIN everywhere e ON b.shape = e.shape JOIN papers_of o ON b.shape = o.shape
  WHERE b.letters >= 4 AND e.at_edge >= :at_edge * e.n AND (b.pages >= 2 AND b.pages >= :min_share * p.pages OR o.papers >= :min_papers)
), counters AS (
  SELECT paper, shape, sum(same) AS pages, max(same) AS in_step FROM (
    SELECT paper, shape, try_cast(regexp_extract(text, '([0-9]+)', 1) AS bigint) - page_no AS ahead, count(DISTINCT page_id) AS same
    FROM edges WHERE shape RLIKE :counter GROUP BY 1, 2, 3
  ) GROUP BY paper, shape
), known AS (
  SELECT paper, shape FROM repeated
  UNION
  SELECT paper, shape FROM counters WHERE 2 * in_step >= pages OR pages <= 2
), close AS (
  SELECT e.page_id, e.line_no, true AS hit FROM edges e JOIN repeated r ON e.paper = r.paper
  WHERE e.shape <> r.shape AND length(r.shape) >= 8 AND levenshtein(e.shape, r.shape, cast(length(r.shape) * :fuzzy AS int)) >= 0
  GROUP BY e.page_id, e.line_no
), firsts AS (
  SELECT paper, lower(regexp_replace(min(struct(page_id, text)).text, '[\\s\u00A0]+', ' ')) AS title, lower(min(struct(page_id, below)).below) AS authors
  FROM edges WHERE page_no = 1 AND from_top <= :edge AND letters >= 12 AND below RLIKE :authors GROUP BY paper
), named AS (
  -- Headers that are a paper's title or first author, however seldom they come.
  SELECT e.page_id, e.line_no FROM (SELECT *, regexp_replace(shape, :around, '') AS bare FROM edges WHERE from_top <= :edge AND page_no > 1) e JOIN firsts f ON e.paper = f.paper
  WHERE length(bare) >= 12 AND levenshtein(bare, left(f.title, length(bare))) <= :fuzzy * length(bare)
    OR shape RLIKE :author_head AND contains(f.authors, regexp_extract(shape, :author_head, 1))
), heads AS (
  SELECT page_id, line_no FROM named UNION
  SELECT page_id, line_no FROM edges
  WHERE from_top <= :edge AND length(shape) >= 12 AND char_length(below) > char_length(text)
    AND levenshtein(shape, left(lower(below), length(shape))) <= length(shape) * :fuzzy
)
SELECT DISTINCT e.page_id, e.line_no FROM edges e
LEFT JOIN known k ON e.paper = k.paper AND e.shape = k.shape
LEFT JOIN close c ON e.page_id = c.page_id AND e.line_no = c.line_no
LEFT JOIN heads h ON e.page_id = h.page_id AND e.line_no = h.line_no
-- The title stands on the authors.
WHERE (k.shape IS NOT NULL OR c.hit OR h.line_no IS NOT NULL)
  AND NOT (e.from_top <= :edge AND coalesce(e.page_no, 1) = 1 AND e.letters >= 12 AND coalesce(e.below, '') RLIKE :authors)
"""

# Body lines with the fragments at a division, which may go on overleaf.
_BODY = """
WITH body AS (
  SELECT l.* FROM {lines} l LEFT ANTI JOIN {furniture} f ON l.page_id = f.page_id AND l.line_no = f.line_no
), around AS (
  SELECT *, lead(text) OVER w AS after, lead(line_no) OVER w AS after_no, lag(text) OVER w AS before, row_number() OVER w AS nth FROM body
  WINDOW w AS (PARTITION BY page_id ORDER BY line_no)
), overleaf AS (
  SELECT paper, page_no, min_by(text, page_id) AS text FROM around WHERE nth = 1 AND page_no IS NOT NULL GROUP BY paper, page_no
)
SELECT a.page_id, a.paper, a.page_no, a.line_no, a.raw, a.text, a.after_no,
  nullif(lower(regexp_extract(a.text, :hyphen, 1)), '') AS front,
  nullif(lower(regexp_extract(coalesce(a.after, o.text), :first, 1)), '') AS rest,
  coalesce(a.before RLIKE :hyphen, a.text RLIKE '^\\\\p{{Ll}}') AS continued,
  regexp_replace(lower(regexp_extract(a.text, :tail, 1)), :inner, '') AS front_token,
  regexp_replace(lower(regexp_extract(coalesce(a.after, o.text), :head, 1)), :inner, '') AS rest_token
FROM around a LEFT JOIN overleaf o ON a.after IS NULL AND a.paper = o.paper AND a.page_no + 1 = o.page_no
"""

# Words of whole tokens; a token at a division is no whole one.
_WORDS = """
WITH tokens AS (
  SELECT page_id, line_no, front, continued, filter(split(text, '[\\\\s\\u00A0]+'), x -> x <> '') AS ws FROM {body}
), each AS (
  SELECT page_id, line_no, pos, w, pos > 0 AND NOT get(ws, pos - 1) RLIKE :sentence AS inside
  FROM tokens LATERAL VIEW posexplode(ws) AS pos, w
  WHERE NOT (pos = size(ws) - 1 AND front IS NOT NULL) AND NOT (pos = 0 AND continued)
)
SELECT page_id, line_no, CAST(NULL AS int) AS after_no, CAST(NULL AS int) AS front_len, inside, part AS token, lower(part) AS word, lower(regexp_replace(w, :inner, '')) AS whole
FROM each LATERAL VIEW explode(transform(split(w, '[-\u2010\u2011\u2013\u2014/]'), x -> regexp_replace(x, :inner, ''))) AS part
WHERE part RLIKE '\\\\p{{L}}'
UNION ALL
-- Divided words, joined.
SELECT page_id, line_no, after_no, char_length(front_token), false, concat(front_token, rest_token), concat(front_token, rest_token), ''
FROM {body} WHERE front_token <> '' AND rest_token <> ''
"""

_VOCABULARY = """
SELECT word, count(*) AS n, count_if(inside AND left(token, 1) <> lower(left(token, 1))) AS as_name FROM {words} GROUP BY word
"""

_DIVIDED = """
WITH breaks AS (
  SELECT front, rest FROM {body} WHERE front IS NOT NULL AND rest IS NOT NULL GROUP BY front, rest
), compounds AS (
  SELECT whole AS pair, count(*) AS n FROM (
    SELECT explode(transform(sequence(1, size(p) - 1), i -> concat(regexp_extract(p[i - 1], '(\\\\p{{L}}+)$', 1), '-', regexp_extract(p[i], '^(\\\\p{{L}}+)', 1)))) AS whole
    FROM (SELECT split(whole, '[-\\u2010\\u2011]') AS p FROM {words} WHERE whole RLIKE '\\\\p{{L}}[-\\u2010\\u2011]\\\\p{{L}}') WHERE size(p) > 1
  ) GROUP BY whole
)
SELECT b.front, b.rest FROM breaks b
LEFT JOIN {vocabulary} j ON concat(b.front, b.rest) = j.word
LEFT JOIN compounds c ON concat(b.front, '-', b.rest) = c.pair
LEFT JOIN {vocabulary} x ON b.front = x.word
LEFT JOIN {vocabulary} y ON b.rest = y.word
-- Neither is known: two words of their own are a compound.
WHERE CASE WHEN j.n IS NULL AND c.n IS NULL THEN x.n IS NULL OR y.n IS NULL OR least(x.n, y.n) < 3
  ELSE coalesce(j.n, 0) > coalesce(c.n, 0) END
"""

# Words by what is left of them when one or two characters are taken out.
_MISREAD = """
WITH vocabulary AS (
  SELECT word, n, as_name, word RLIKE :odd OR word RLIKE :numeral AS odd, word RLIKE '[^\\\\p{{L}}]' AS signs FROM {vocabulary} WHERE char_length(word) >= 2
), gaps AS (
  SELECT v.*, width, concat(left(word, at), '*', substring(word, at + width + 1)) AS gap, at, substring(word, at + 1, width) AS part
  FROM vocabulary v LATERAL VIEW explode(array(1, 2)) AS width LATERAL VIEW explode(sequence(0, greatest(char_length(word) - width, 0))) AS at
  WHERE char_length(word) >= width + 1 AND (char_length(word) > 3 OR width = 1)
), pairs AS (
  SELECT w.word, w.signs, w.odd, v.word AS right_word, v.n AS right_n, w.n, w.at, w.part AS x, v.part AS y
  FROM gaps w JOIN gaps v ON w.gap = v.gap AND w.width + v.width <= 3
  WHERE v.n >= :rarer * w.n AND NOT v.signs AND v.as_name <= 0.1 * v.n AND w.part <> v.part
    AND (w.signs OR w.as_name = 0 AND char_length(w.word) >= 3) AND NOT contains(w.part, v.part) AND NOT contains(v.part, w.part)
), confusions AS (
  SELECT x, y, percentile_approx(n / right_n, 0.5) AS rate FROM pairs GROUP BY x, y HAVING count(DISTINCT word) >= :confused
), taken AS (
  SELECT p.word, max_by(struct(p.right_word, p.at), p.right_n) AS best
  FROM pairs p LEFT JOIN confusions c ON p.x = c.x AND p.y = c.y
  -- A word far more frequent than its confusion is one of its own.
  WHERE c.x IS NOT NULL AND p.n <= greatest(3, :usual * c.rate * p.right_n) OR p.x RLIKE '[^\\\\p{{L}}]' GROUP BY p.word
)
SELECT v.word, t.best.right_word, t.best.at FROM vocabulary v LEFT JOIN taken t ON v.word = t.word WHERE t.word IS NOT NULL OR v.odd
"""


class Scans:
    """Lines of scanned pages and what was found on them; each table is written once."""

    def __init__(self, pages: DataFrame):
        self.spark = pages.sparkSession
        self.lines = self._table("lines", _LINES, pages=pages.select("page_id", "page", "content"))
        self.furniture = self._table("furniture", _FURNITURE, lines=self.lines)
        self.body = self._table("body", _BODY, lines=self.lines, furniture=self.furniture)
        self.words = self.spark.sql(_WORDS, args=_ARGS, body=self.body)
        self.vocabulary = self._table("vocabulary", _VOCABULARY, words=self.words)
        self.divided = self._table("divided", _DIVIDED, body=self.body, words=self.words, vocabulary=self.vocabulary)
        self.misread = self._table("misread", _MISREAD, vocabulary=self.vocabulary)

    def _table(self, name: str, sql: str, **tables: DataFrame) -> DataFrame:
        used = {k: v for k, v in _ARGS.items() if f":{k}" in sql}
        return write_table(self.spark.sql(sql, args=used, **tables), scratch(self.spark, f"scan-{name}"))

    def hyphens(self) -> DataFrame:
        joined = self.body.join(self.divided, ["front", "rest"])
        # Where the page and the paper end, a front that is no word was divided.
        last = self.body.where("front IS NOT NULL AND rest IS NULL").join(self.vocabulary.where("n >= 3").select(F.col("word").alias("front")), "front", "left_anti")
        return joined.select("page_id", "line_no").unionByName(last.select("page_id", "line_no"))

    def misreads(self) -> DataFrame:
        """A divided word's misreading is on the line that has its place."""
        line = F.when(F.col("at") >= F.col("front_len"), F.col("after_no")).otherwise(F.col("line_no"))
        return self.words.join(self.misread, "word").select("page_id", line.alias("line_no"), "token", "right_word").where("line_no IS NOT NULL")


def scan_noise(pages: DataFrame) -> DataFrame:
    """``page_id, line_no, kind``: one row per line and kind of noise (``hyphen``, ``furniture``, ``misread``).

    ``pages`` has ``page_id, page, content``. A null id or content gives no rows;
    blank lines and code fences around a page are no lines of it. A page without a
    path is a paper of its own. Other columns are not read.
    """
    s = Scans(pages)
    kinds = {"hyphen": s.hyphens(), "furniture": s.furniture, "misread": s.misreads()}
    rows = [df.select("page_id", "line_no", F.lit(k).alias("kind")) for k, df in kinds.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).distinct()


_PARAGRAPHS = """
WITH fixes AS (
  SELECT page_id, line_no, array_distinct(collect_list(struct(token, CASE WHEN left(token, 1) <> lower(left(token, 1)) THEN concat(upper(left(right_word, 1)), substring(right_word, 2)) ELSE right_word END AS word))) AS fixes
  FROM {misreads} WHERE right_word IS NOT NULL GROUP BY page_id, line_no
), lines AS (
  SELECT b.page_id, b.line_no, d.front IS NOT NULL AS joined,
    b.raw RLIKE '^[\\\\s\\u00A0]' OR b.line_no - lag(b.line_no) OVER (PARTITION BY b.page_id ORDER BY b.line_no) > 1 AND g.line_no IS NULL OR b.text RLIKE '^#' AS opens,
    aggregate(coalesce(f.fixes, array()), CASE WHEN d.front IS NOT NULL THEN left(b.text, char_length(b.text) - 1) ELSE b.text END, (t, x) -> replace(t, x.token, x.word)) AS text
  FROM {body} b
  LEFT JOIN fixes f ON b.page_id = f.page_id AND b.line_no = f.line_no
  LEFT JOIN {divided} d ON b.front = d.front AND b.rest = d.rest
  LEFT JOIN {furniture} g ON b.page_id = g.page_id AND b.line_no = g.line_no + 1
), placed AS (
  SELECT page_id, line_no, joined, text, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY line_no) AS paragraph FROM lines
)
SELECT page_id, cast(paragraph AS int) AS paragraph,
  rtrim(array_join(transform(array_sort(collect_list(struct(line_no, text, joined))), x -> CASE WHEN x.joined OR x.text RLIKE '\\\\p{{L}}[-\\u2010\\u2011]$' THEN x.text ELSE concat(x.text, ' ') END), '')) AS text
FROM placed GROUP BY page_id, paragraph
"""


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """``page_id, paragraph, text``: the pages' continuous paragraphs, without furniture, with words joined and misreadings mended."""
    s = Scans(pages)
    return s.spark.sql(_PARAGRAPHS, misreads=s.misreads(), body=s.body, divided=s.divided, furniture=s.furniture)
