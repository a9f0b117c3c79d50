"""WARC derivatives: linked metadata and plain-text conversion records for response records.

Column expressions only. Every derived record refers to its response by the identifier that the
source gives, or by one derived from id, address and payload digest, so that it is the same on every
run. A page's text is made in few passes: three over the tags, then pieces between ampersands and
lines, and runs of blanks only where a page has any.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text, and elements that end a line.
SILENT = ("script", "style", "noscript", "template")
BREAKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
#: Character references by name, all that HTML has (a space for one that does not break); references by number are resolved all.
REFERENCES = {n[:-1]: c for n, c in html5.items() if n.endswith(";")} | {"nbsp": " "}
LONGEST = max(map(len, REFERENCES))
#: Comments and silent elements, tags that end a line, and all other tags.
UNSEEN = "(?is)<(?:!--.*?-->|" + "|".join(f"{t}(?:[ \\t\\r\\n/][^>]*)?>.*?</{t}[^>]*>" for t in SILENT) + ")"
LINE_TAGS, TAGS = f"(?i)</?(?:{BREAKS})(?:[ \\t\\r\\n/][^>]*)?>", "<[A-Za-z/!?][^>]*>"
TITLE, LANG, LINKS = "(?is)<title[^>]*>(.*?)</title", "(?i)<html[^>]*[ \\t\\r\\n]lang=[\"']?([^\"' \\t\\r\\n>]*)", "(?i)<a[ \\t\\r\\n][^>]*href="


def _without_tags(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), LINE_TAGS, "\n"), TAGS, "")


def _reference(name: Column) -> Column:
    """The character that a reference stands for, given what is between & and ;, or null."""
    code = F.when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 7).cast("long")).when(name.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10).cast("long"))
    real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    # a map of maps, so that a look-up goes through the names of one first letter only; it is a constant of the plan
    letters: dict[str, dict[str, str]] = {}
    for n, c in REFERENCES.items():
        letters.setdefault(n[0], {})[n] = c
    names = F.from_json(F.lit(json.dumps(letters)), "map<string,map<string,string>>")
    named = F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)
    return F.coalesce(named, F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def _resolved(text: Column) -> Column:
    """Character references are resolved once, from left to right; what is none stays as it stands."""

    def piece(p: Column, i: Column) -> Column:
        end = F.instr(F.substring(p, 1, LONGEST + 1), ";")
        char = F.when((i > 0) & (end > 2), _reference(F.substring(p, F.lit(1), end - 1)))
        return F.when(char.isNotNull(), F.concat(char, F.substring(p, end + 1, F.length(p)))).when(i > 0, F.concat(F.lit("&"), p)).otherwise(p)

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), piece), "")).otherwise(text)


def _in_lines(text: Column) -> Column:
    """Runs of blanks are one space; lines are trimmed, and empty ones go."""
    some = reduce(or_, [text.contains(x) for x in ("  ", "\t", "\r", "\x0b", "\x0c")])
    even = F.when(some, F.regexp_replace(text, "[ \\t\\r\\x0b\\x0c]+", " ")).otherwise(text)
    return F.array_join(F.filter(F.transform(F.split(even, "\n", -1), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def plain_text(html: Column) -> Column:
    """Text of a page: comments and silent elements go, block elements end lines, references are resolved, blanks collapse."""
    return _in_lines(_resolved(_without_tags(html)))


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def identifier(*parts: Column) -> Column:
    """A URN with a version-8 UUID made of the digest of the parts."""
    h = F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-8"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def derive(
    responses: DataFrame,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    record_id: str | None = None,
    date: str | None = None,
    source_headers: str | None = None,
) -> DataFrame:
    """Two records per response: key, record_type, record_id, refers_to, target_uri, warc_date,
    content_type, content_length, block_digest, source_digest, source_headers, block.

    The metadata record holds title, language, number of links and size as warc-fields; the
    conversion record the plain text. record_id, date and source_headers name columns of the source
    that are carried over; what it does not give is derived (identifier) or null. Null payloads
    count as empty and null addresses stay null; repeated rows give equal records again. Column
    names of the source do not matter beyond those named. An empty table gives no records. A very long page is
    read as a whole by one task, in a fixed number of passes. A `<` that starts no tag (no letter, /, ! or ? behind
    it) is text. Names of references are those of HTML, with their semicolon.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    named = responses.select(F.col(key).alias("key"), F.col(uri).alias("target_uri"), body.alias("body"), digest(body).alias("source_digest"), *[c.alias(n) for n, c in (
        ("given", F.col(record_id).cast("string") if record_id else F.lit(None).cast("string")),
        ("warc_date", F.col(date).cast("string") if date else F.lit(None).cast("string")),
        ("source_headers", F.col(source_headers).cast("string") if source_headers else F.lit(None).cast("string")),
    )])
    own = identifier(F.lit("response"), F.col("key"), F.col("target_uri"), F.col("source_digest"))
    # one step each, so that no text is made twice
    base = named.withColumn("refers_to", F.coalesce("given", own)).withColumn("text", _without_tags(F.col("body"))).withColumn("text", _resolved(F.col("text"))).withColumn("text", _in_lines(F.col("text")))
    title = plain_text(F.regexp_extract("body", TITLE, 1))
    fields = F.concat(
        F.lit("title: "), F.replace(title, F.lit("\n"), F.lit(" ")), F.lit("\r\nlanguage: "), F.regexp_extract("body", LANG, 1), F.lit("\r\nlinks: "), F.regexp_count("body", F.lit(LINKS)).cast("string"),
        F.lit("\r\npayload-length: "), F.octet_length("body").cast("string"), F.lit("\r\n"),
    )
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=UTF-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = base.select("key", "target_uri", "source_digest", "refers_to", "warc_date", "source_headers", F.inline(made))
    return rows.select(
        F.col("key").alias(key), "record_type", identifier(F.col("record_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri", "warc_date",
        "content_type", F.octet_length("block").cast("long").alias("content_length"), digest(F.col("block")).alias("block_digest"), "source_digest", "source_headers", "block",
    )


def rendered(records: DataFrame, now: str | None = None) -> DataFrame:
    """One column warc: each record as it stands in a WARC/1.1 file, headers without a value left out.

    The format demands a WARC-Date: records without one take now (default: when this is run, in UTC).
    """
    moment = F.lit(now) if now else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    records = records.withColumn("warc_date", F.coalesce("warc_date", moment))
    head = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(c).cast("string")))
    lines = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), head("WARC-Type", "record_type"), head("WARC-Record-ID", "record_id"), head("WARC-Refers-To", "refers_to"), head("WARC-Target-URI", "target_uri"),
        head("WARC-Date", "warc_date"), head("WARC-Block-Digest", "block_digest"), head("WARC-Source-Payload-Digest", "source_digest"), F.col("source_headers"),
        head("Content-Type", "content_type"), head("Content-Length", "content_length"),
    )
    return records.select(F.concat(lines, F.lit("\r\n\r\n"), F.col("block")).alias("warc"))


def write_warc(records: DataFrame, path: str, now: str | None = None) -> None:
    """Files of records, each followed by two line ends, as the format asks."""
    rendered(records, now).write.option("lineSep", "\r\n\r\n").text(path)


def _sql_text(c: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    for pattern, to in ((UNSEEN, "''"), (LINE_TAGS, "chr(10)"), (TAGS, "''")):
        c = f"regexp_replace({c}, {quote(pattern)}, {to}, 'g')"
    name = "split_part(p, ';', 1)"
    code = f"CASE WHEN regexp_full_match({name}, '#[0-9]{{1,7}}') THEN CAST(substr({name}, 2) AS BIGINT) WHEN regexp_full_match({name}, '#[xX][0-9a-fA-F]{{1,6}}') THEN CAST('0x' || substr({name}, 3) AS BIGINT) END"
    char = f"coalesce((MAP {{{', '.join(f'{quote(n)}: {quote(ch)}' for n, ch in REFERENCES.items())}}})[{name}], CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr(CAST({code} AS INTEGER)) END)"
    piece = f"CASE WHEN contains(p, ';') AND length({name}) BETWEEN 2 AND {LONGEST} THEN coalesce({char} || substr(p, length({name}) + 2), '&' || p) ELSE '&' || p END"
    c = f"(SELECT split_part(t, '&', 1) || array_to_string(list_transform(string_split(t, '&')[2:], lambda p: {piece}), '') FROM (SELECT {c} AS t) q)"
    c = f"regexp_replace({c}, '[ \\t\\r\\x0b\\x0c]+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({c}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


def _sql_id(*parts: str) -> str:
    h = "sha256(" + " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-8' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'"


ORACLE_SQL = f"""
WITH base AS (
  SELECT *, {_sql_id("'response'", "page_id", "url", "source_digest")} AS refers_to
  FROM (SELECT page_id, url, coalesce(html, '') AS body, 'sha256:' || sha256(coalesce(html, '')) AS source_digest FROM pages) p
), made AS (
  SELECT page_id, url, source_digest, refers_to, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'title: ' || regexp_replace({_sql_text("regexp_extract(body, '" + TITLE + "', 1)")}, '\\n', ' ', 'g')
         || chr(13) || chr(10) || 'language: ' || regexp_extract(body, '{LANG.replace("'", "''")}', 1)
         || chr(13) || chr(10) || 'links: ' || CAST(len(regexp_extract_all(body, '{LINKS}')) AS VARCHAR)
         || chr(13) || chr(10) || 'payload-length: ' || CAST(octet_length(encode(body)) AS VARCHAR) || chr(13) || chr(10) AS block
  FROM base
  UNION ALL
  SELECT page_id, url, source_digest, refers_to, 'conversion', 'text/plain; charset=UTF-8', {_sql_text("body")}
  FROM base
)
SELECT page_id, record_type, {_sql_id("record_type", "refers_to")} AS record_id, refers_to, url AS target_uri, CAST(NULL AS VARCHAR) AS warc_date,
       content_type, CAST(octet_length(encode(block)) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
       source_digest, CAST(NULL AS VARCHAR) AS source_headers, block
FROM made
"""
