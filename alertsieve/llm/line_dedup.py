"""Line dedup by site-relative frequency.

Pages are cut into visible lines and grouped by host.  A line is boilerplate on a host when the
part of the host's pages that contain it exceeds a ratio; such lines are dropped from the host's
pages.  Hosts with few pages are left alone, as one page says nothing about a site.

Only hashes of lines are counted, map-side first.  A host has fewer boilerplate lines than its
mean number of lines per page divided by the ratio, so they fit one row per host; that table is
written, and the join to the pages is two plain shuffles that Spark can split for a hot host.

Defined results: the host is the lower-cased host name of the url ('' for NULL or none); a NULL
page has no lines; a line that repeats on a page counts once; rows that repeat a page count as
pages of their own.  Lines are compared by 64-bit hashes.  All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A line on more than this part of a host's pages is boilerplate; hosts from MIN_PAGES on.
RATIO, MIN_PAGES = (3, 10), 5
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
#: Applied in order to a page; then lines are split, squeezed and trimmed.
STRIP = [
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"[\n\r]+", " "),
    (r"(?i)</?(?:p|div|li|ul|ol|nav|h[1-6]|br|hr|tr|td|th|table|article|section|header|footer|aside|main|title"
     r"|head|body|html|pre|blockquote|form|dl|dt|dd)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
#: The named characters that are read.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def visible_lines(html: Column) -> Column:
    out = F.coalesce(html, F.lit(""))
    for pattern, by in STRIP:
        out = F.regexp_replace(out, pattern, by)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    lines = F.transform(F.split(out, "\n", -1), lambda x: F.trim(F.regexp_replace(x, r"[ \t\x0B\x0C\x{A0}]+", " ")))
    return F.filter(lines, lambda x: x != "")


def drop_boilerplate(pages: DataFrame, url: str = "url", html: str = "html", ratio: tuple[int, int] = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """The columns of ``pages`` but its html, and: host, n_lines, n_dropped, text (kept lines);
    columns of ``pages`` with these names are replaced."""
    pages = pages.drop(*[c for c in ("host", "n_lines", "n_dropped", "text") if c not in (url, html)])
    names = [c for c in pages.columns if c != html]
    safe = [f"c{i}" for i in range(len(names))]
    rows = pages.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(names, safe)],
                        host_of(F.col(f"`{url}`")).alias("host"), visible_lines(F.col(f"`{html}`")).alias("lines"))
    # lines are taken out of the page once; what follows reads them
    rows = stored(rows.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x))), "line-pages")
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    counts = (rows.select("host", F.explode(F.array_distinct("hashes")).alias("line"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")))
    dropped = stored(counts.join(totals, "host").filter(F.col("n") * ratio[1] > F.col("pages") * ratio[0])
                     .groupBy("host").agg(F.collect_set("line").alias("dropped")), "line-boilerplate")
    joined = rows.join(dropped, "host", "left")
    keep = F.filter(F.arrays_zip("lines", "hashes"),
                    lambda x: F.col("dropped").isNull() | ~F.array_contains("dropped", x["hashes"]))
    made = joined.withColumn("kept", keep)
    return made.select(*[F.col(s).alias(c) for c, s in zip(names, safe)], "host",
                       F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                       F.array_join(F.col("kept.lines"), "\n").alias("text"))


def oracle_sql(ratio=RATIO, min_pages=MIN_PAGES) -> str:
    """The same rows as DuckDB SQL over ``pages``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    text = "coalesce(html, '')"
    for pattern, by in STRIP:
        text = f"regexp_replace({text}, {quoted(pattern)}, {'chr(10)' if by == chr(10) else quoted(by)}, 'g')"
    for name, char in ENTITIES:
        text = f"replace({text}, {quoted(name)}, {quoted(char)})"
    space = quoted(r"[ \t\x0B\x0C\x{A0}]+")
    return f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, url, lower(regexp_extract(coalesce(url, ''), {quoted(HOST)}, 1)) AS host,
  list_filter(list_transform(string_split({text}, chr(10)),
    lambda x: trim(regexp_replace(x, {space}, ' ', 'g'))), lambda x: x <> '') AS lines FROM pages),
l AS (SELECT rid, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM p),
bad AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT rid) AS n FROM l GROUP BY ALL)
  JOIN (SELECT host, count(*) AS pages FROM p GROUP BY ALL) USING (host)
  WHERE pages >= {min_pages} AND n * {ratio[1]} > pages * {ratio[0]}),
k AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM l ANTI JOIN bad USING (host, line) GROUP BY rid)
SELECT page_id, url, host, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
  coalesce(text, '') AS text FROM p LEFT JOIN k USING (rid)
"""
