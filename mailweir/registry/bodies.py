"""Body decoding and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailweir.functions import encoding, html, text
from mailweir.functions import patterns as P
from mailweir.operators.project import pick_body, scan_headers, to_mail
from mailweir.registry import derive as D
from mailweir.registry.derive import READABLE_SQL, over_mail, over_scan
from mailweir.registry.profiling import body_sql


def _docs(spark, sf):
    return D.table(spark, sf, "documents")


def pick_bodies(spark, sf):
    """The encoded body of every message, from the right place."""
    return D.raw_documents(spark, sf).select("pos", pick_body(F.col("payload")).alias("data"))


def decode_body(spark, sf):
    data = pick_body(F.col("payload"))
    decoded = encoding.utf8_replace(encoding.b64_decode(data))
    return D.raw_documents(spark, sf).filter(data.isNotNull()).select("pos", decoded.alias("text"))


def transfer_decode(spark, sf):
    """Each document's text in the encoding its language stands for, decoded again."""
    line = F.replace(F.replace(F.col("text"), F.lit("="), F.lit("=3D")), F.lit("é"), F.lit("=C3=A9"))
    quoted = F.replace(line, F.lit(" "), F.lit(" =\r\n"))
    written = _docs(spark, sf).select(
        "doc_id", "lang",
        F.when(F.col("lang") == "fr", F.lit("quoted-printable"))
        .when(F.col("lang") == "de", F.lit("base64"))
        .when(F.col("lang") == "es", F.lit("7bit")).alias("encoding"),
        F.when(F.col("lang") == "fr", quoted)
        .when(F.col("lang") == "de", F.base64("text"))
        .otherwise(F.col("text")).alias("data"),
    )
    decoded = encoding.transfer_decode(F.col("data"), F.col("encoding"))
    return written.select("doc_id", decoded.alias("text"))


def html_unescape(spark, sf):
    return D.table(spark, sf, "pages", heavy=True).select(
        "page_id", html.html_unescape(F.col("html")).alias("text")
    )


def html_text(spark, sf):
    return D.table(spark, sf, "pages", heavy=True).select(
        "page_id", html.html_text(F.col("html")).alias("text")
    )


def extract_urls(spark, sf):
    urls = text.extract_urls(F.col("content"))
    return D.mail(spark, sf, heavy=True).select("pos", F.posexplode(urls).alias("n", "url"))


def page_links(spark, sf):
    """Links of web pages' addresses and markup: '#' and '~' end them."""
    whole = F.concat_ws(" ", "url", "html")
    return D.table(spark, sf, "pages", heavy=True).select(
        "page_id", F.posexplode(text.extract_urls(whole)).alias("n", "url")
    )


def clean_text(spark, sf):
    return D.mail(spark, sf, heavy=True).select("pos", text.clean_text(F.col("content")).alias("clean"))


def _shown(body):
    return [
        body["clean_text"].alias("clean"), text.size_or_zero(body["urls"]).alias("n_urls"),
        F.array_join(body["urls"], " ").alias("urls"), body["length"].alias("length"),
    ]


def structure_body(spark, sf):
    rows = D.mail(spark, sf, heavy=True).select("pos", text.structure_body(F.col("content")).alias("body"))
    return rows.select("pos", *_shown(F.col("body")))


def lengths(spark, sf):
    return _docs(spark, sf).select("doc_id", text.code_points(F.col("text")).cast("bigint").alias("length"))


def to_mail_plain(spark, sf):
    """Raw messages to mail records, end to end."""
    rows = to_mail(scan_headers(D.raw_documents(spark, sf)), "pos")
    return rows.select(
        "pos", "id", F.col("threadId").alias("thread"), F.col("from").alias("sender"), "subject", "parsed_iso", "status", "snippet",
        F.array_join("labelIds", ",").alias("labels"), *_shown(F.col("body")),
    )


def to_mail_html(spark, sf):
    """HTML messages to mail records, end to end."""
    rows = to_mail(scan_headers(D.raw_pages(spark, sf)), "pos")
    return rows.select("pos", "id", F.col("from").alias("sender"), "subject", *_shown(F.col("body")))


def html_attributes(spark, sf):
    """Tags of every way of quoting around text that must stay: the words of each page's url."""
    words = F.regexp_replace("url", "[^a-z0-9]+", " ")
    tags = ("<a title=it's>", "</a> ", "<b x='p > q' y=o'k>", "</b> ", '<i d="it\'s > 5" e>', "</i><br/>")
    pieces = [F.lit(tags[0]), words, F.lit(tags[1]), F.lit(tags[2]), F.lit("two"), F.lit(tags[3]),
              F.lit(tags[4]), F.col("page_id").cast("string"), F.lit(tags[5])]
    return D.table(spark, sf, "pages", heavy=True).select("page_id", html.html_text(F.concat(*pieces)).alias("text"))


QUERIES = {
    f.__name__: f
    for f in (
        html_attributes, pick_bodies, decode_body, transfer_decode, html_unescape, html_text, extract_urls,
        page_links, clean_text, structure_body, lengths, to_mail_plain, to_mail_html,
    )
}


def _unescape_sql(column: str) -> str:
    return (
        f"regexp_replace(replace(replace(replace({column}, '&copy;', '©'), '&middot;', '·'), "
        "'&quot;', '\"'), '&amp;?', '&', 'g')"
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_STRIP = rf"\A{P.SPACES}|{P.SPACES}\z"


def _tidy_sql(expr: str) -> str:
    joined = f"regexp_replace({expr}, {_quoted(P.CHUNK_GAP)}, ' ', 'g')"
    return f"regexp_replace({joined}, {_quoted(_STRIP)}, '', 'g')"


_MARKUP = f"regexp_replace(html, {_quoted(P.MARKUP_RE2)}, ' ', 'g')"
_PAGE_TEXT = _tidy_sql(_unescape_sql(_MARKUP))
_PAGES = f"page_text AS (SELECT page_id AS pos, url, html, {_PAGE_TEXT} AS text FROM pages)"
_SHOWN = "clean, CAST(coalesce(len(urls), 0) AS INT) AS n_urls, array_to_string(urls, ' ') AS urls, CAST(length(clean) AS INT) AS length"
_DATA = "translate(to_base64(encode({0})), '+/', '-_')"

ORACLE = {
    "pick_bodies": over_mail(
        f"SELECT pos, CASE WHEN {READABLE_SQL} <> '' THEN {_DATA.format(READABLE_SQL)} END AS data FROM mail"
    ),
    "decode_body": over_mail(
        f"""SELECT pos, decode(from_base64(translate(data, '-_', '+/'))) AS text FROM (
  SELECT pos, {_DATA.format(READABLE_SQL)} AS data FROM mail WHERE {READABLE_SQL} IS NOT NULL)"""
    ),
    "transfer_decode": "SELECT doc_id, text FROM documents",
    "html_unescape": f"SELECT page_id, {_unescape_sql('html')} AS text FROM pages",
    "html_attributes": """SELECT page_id, trim(regexp_replace(url, '[^a-z0-9]+', ' ', 'g')) || ' two ' || page_id AS text FROM pages""",
    "html_text": f"SELECT page_id, {_PAGE_TEXT} AS text FROM pages",
    "extract_urls": over_mail(
        """SELECT pos, CAST(i - 1 AS INT) AS n, urls[i] AS url FROM (SELECT pos, urls, unnest(range(1, len(urls) + 1)) AS i FROM (
  SELECT pos, list_transform(regexp_extract_all(content, 'https?://[!$-_a-z]+'), lambda u: regexp_replace(u, '[.,;!?)]+$', '')) AS urls FROM mail))"""
    ),
    "page_links": """SELECT page_id, CAST(i - 1 AS INT) AS n, urls[i] AS url FROM (SELECT page_id, urls, unnest(range(1, len(urls) + 1)) AS i FROM (
  SELECT page_id, list_transform(regexp_extract_all(url || ' ' || html, 'https?://[!$-_a-z]+'), lambda u: regexp_replace(u, '[.,;!?)]+$', '')) AS urls FROM pages))""",
    "clean_text": over_mail(
        "SELECT pos, coalesce(clean, '') AS clean FROM bodies", body_sql("mail", "content", "pos")
    ),
    "structure_body": over_mail(
        f"SELECT pos, {_SHOWN} FROM bodies", body_sql("mail", "coalesce(content, '')", "pos")
    ),
    "lengths": "SELECT doc_id, n_chars AS length FROM documents",
    "to_mail_plain": over_scan(
        f"""SELECT pos, id, thread, sender, subject, iso AS parsed_iso, 'success' AS status, source AS snippet, upper(lang) AS labels, {_SHOWN} FROM bodies""",
        body_sql("scanned", READABLE_SQL, "pos, id, thread, sender, subject, iso, lang, source"),
    ),
    "to_mail_html": "WITH " + ",\n".join((
        _PAGES, body_sql("page_text", "text", "pos, url, html"),
    )) + rf"""
SELECT pos, 'p' || md5(html) AS id, regexp_extract(url, '^https?://([^/]+)', 1) AS sender, url AS subject, {_SHOWN} FROM bodies""",
}
