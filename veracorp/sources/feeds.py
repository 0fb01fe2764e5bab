"""Landed feed documents and posts to records.

Network fetching is out of scope; these read feed XML and post JSON that
have already been landed in the shared folder.  A landed value is a whole
feed document or a fragment of one (RSS 2.0, RSS 1.0, Atom, bare items): it
goes through Spark's XML parser, so entities, CDATA, attributes, comments and
namespaces read as XML says.  ``read_items`` and the stream share
``feed_items`` and ``item_records``.  Per-feed / per-query caps
are ``row_number() <= cap`` windows, which plan a partial WindowGroupLimit,
so a feed holding a third of all items still sends only ``cap`` rows per
task to the final window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracorp.functions.text import any_keyword, squash_whitespace
from veracorp.operators.corpus import dedup_first
from veracorp.sources.files import parse_date
from veracorp.sources.tables import table

_ITEM = ("struct<title:string,description:string,summary:string,content:string,link:array<struct<_VALUE:string,_href:string,_rel:string>>,"
         "pubDate:string,published:string,updated:string,feed:string,ord:string>")
_DOCUMENT = (f"rss array<struct<channel:array<struct<item:array<{_ITEM}>>>>>, RDF array<struct<item:array<{_ITEM}>>>, "
             f"channel array<struct<item:array<{_ITEM}>>>, feed array<struct<entry:array<{_ITEM}>>>, item array<{_ITEM}>, entry array<{_ITEM}>")
_XML_OPTIONS = {"ignoreNamespace": "true", "attributePrefix": "_", "valueTag": "_VALUE", "rowTag": "feeds", "ignoreSurroundingSpaces": "false"}
# What XML 1.0 does not allow in a document.
_NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"
# HTML names that feeds use without declaring them (fixed values).
HTML_ENTITIES = {"nbsp": 160, "copy": 169, "reg": 174, "laquo": 171, "raquo": 187, "ndash": 8211, "mdash": 8212, "lsquo": 8216,
                 "rsquo": 8217, "ldquo": 8220, "rdquo": 8221, "bull": 8226, "hellip": 8230, "euro": 8364, "trade": 8482}


def _xml_escape(c):
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"), ("\r", "&#13;"), ("\n", "&#10;")):
        c = F.regexp_replace(c, char, name)
    return c


def land_feed(corpus: DataFrame, path: str) -> None:
    """One feed document or fragment per corpus row (feed = source), as text lines: by doc_id in turn a bare
    item with escaped text, one in CDATA, a whole RSS document with a namespace, a whole Atom document."""
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") * 3600)
    text = F.regexp_replace("text", _NOT_XML, " ")
    first = F.substring_index(text, "\n", 1)
    rest = F.substr(text, F.length(first) + 2)
    link = F.concat(F.lit("http://"), F.col("source_id"), F.lit(".example/"), F.col("doc_id").cast("string"))
    date = F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss Z")

    def element(name, content):
        return F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name.split()[0]}>"))

    def cdata(c):   # line ends and the closing mark cannot stand in a line of CDATA
        whole = F.concat(F.lit("<![CDATA["), c, F.lit("]]>"))
        return F.when(c.rlike(r"[\r\n]|\]\]>"), _xml_escape(c)).otherwise(whole)

    own = [element("feed", F.col("source_id")), element("ord", F.col("doc_id").cast("string"))]
    escaped = [element("title", _xml_escape(first)), element("description", _xml_escape(rest))]
    wrapped = [element('title type="html"', cdata(first)), element("description", cdata(rest))]
    rss = [element("link", link), element("pubDate", date), *own]
    atom = [element("title", _xml_escape(first)), element("summary", _xml_escape(rest)), F.concat(F.lit('<link rel="self" href="self"/><link href="'), link, F.lit('"/>')),
            element("updated", date), *own]
    forms = (element("item", F.concat(*escaped, *rss)), element('item about="x"', F.concat(*wrapped, *rss)),
             F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0" xmlns:x="urn:x"><channel><title>all</title><x:item>'), F.concat(*escaped, *rss),
                      F.lit("</x:item></channel></rss>")),
             F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>all</title><!-- <entry> --><entry>'), F.concat(*atom), F.lit("</entry></feed>")))
    turn = F.pmod("doc_id", F.lit(len(forms)))
    value = F.coalesce(*[F.when(turn == i, f) for i, f in enumerate(forms)])
    corpus.select(value.alias("value")).write.mode("errorifexists").text(path)


def _items_of(value: Column) -> Column:
    """The items and entries of a feed document or of a run of fragments, wherever they stand in it."""
    bare = F.regexp_replace(value, r"(?s)<\?.*?\?>|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>", "")
    tree = F.from_xml(F.concat(F.lit("<feeds>"), bare, F.lit("</feeds>")), _DOCUMENT, _XML_OPTIONS)
    none = F.array().cast(f"array<{_ITEM}>")

    def inside(parents: Column, name: str) -> Column:
        return F.flatten(F.transform(parents, lambda p: F.coalesce(p[name], none)))

    channels = F.flatten(F.transform(F.coalesce(tree["rss"], F.array().cast(f"array<struct<channel:array<struct<item:array<{_ITEM}>>>>>")),
                                     lambda r: F.coalesce(r["channel"], F.array().cast(f"array<struct<item:array<{_ITEM}>>>"))))
    parts = [inside(channels, "item"), inside(tree["channel"], "item"), inside(tree["RDF"], "item"), tree["item"],
             inside(tree["feed"], "entry"), tree["entry"]]
    return F.concat(*[F.coalesce(p, none) for p in parts])


def _repaired(value: Column) -> Column:
    """Text of a document that is no XML, with undeclared names and loose ampersands written as XML wants them."""
    for name, code in HTML_ENTITIES.items():
        value = F.regexp_replace(value, f"&{name};", f"&#{code};")
    return F.regexp_replace(value, r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)", "&amp;")


def feed_items(documents: DataFrame, value: str = "value") -> DataFrame:
    """title, description, link, pubDate, feed, ord of every item in a table (or stream) of feed documents.

    A missing element is null.  The description is RSS's ``description``, else Atom's ``summary``, else ``content``;
    the link is its text, else the href of the first link that is an alternate; the date is pubDate, else published,
    else updated.  A document that is no XML is read once more with undeclared entities mended; if it still is none,
    it has no items (``malformed`` lists such documents).
    """
    clean = F.regexp_replace(value, _NOT_XML, " ")
    strict = documents.select(clean.alias("_v")).select("_v", _items_of(F.col("_v")).alias("_i"))
    mended = F.when(_unread("_i", "_v"), _items_of(_repaired(F.col("_v")))).otherwise(F.col("_i"))
    item = strict.select(F.explode(mended).alias("i")).select("i.*")
    alternate = F.get(F.filter("link", lambda x: x["_href"].isNotNull() & F.coalesce(x["_rel"] == "alternate", F.lit(True))), 0)["_href"]
    any_link = F.get(F.col("link"), 0)
    text_link = F.trim(F.get(F.filter("link", lambda x: F.length(F.trim(x["_VALUE"])) > 0), 0)["_VALUE"])
    return item.select("title", F.coalesce("description", "summary", "content").alias("description"),
                       F.coalesce(text_link, alternate, any_link["_href"], any_link["_VALUE"]).alias("link"),
                       F.trim(F.coalesce("pubDate", "published", "updated")).alias("pubDate"), F.trim("feed").alias("feed"),
                       F.expr("try_cast(trim(ord) AS BIGINT)").alias("ord"))


def _unread(items: str, value: str) -> Column:
    return (F.size(items) == 0) & F.col(value).rlike(r"<(?:[\w.-]+:)?(?:item|entry)[\s>/]")


def malformed(documents: DataFrame, value: str = "value") -> DataFrame:
    """Documents that name items but cannot be read as XML, mended or not."""
    clean = F.regexp_replace(value, _NOT_XML, " ")
    both = documents.withColumn("_v", clean).withColumn("_i", F.concat(_items_of(F.col("_v")), _items_of(_repaired(F.col("_v")))))
    return both.where(_unread("_i", "_v")).select(*documents.columns)


def read_items(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Items of landed feed text: a document or fragment per line, or with ``whole_files`` one per file."""
    return feed_items(spark.read.text(path, wholetext=whole_files))


def item_records(items: DataFrame, label: str = "Real") -> DataFrame:
    """source, ord, text, label, date, url, year of items that have a title or a description."""
    title = squash_whitespace(F.coalesce(F.col("title"), F.lit("")))
    desc = squash_whitespace(F.coalesce(F.col("description"), F.lit("")))
    joined = F.regexp_replace(F.concat(title, F.lit(". "), desc), r"^[. ]+|[. ]+$", "")
    rec = (items.where((F.length(title) > 0) | (F.length(desc) > 0))
           .select(F.col("feed").alias("source"), "ord", squash_whitespace(joined).alias("text"), F.lit(label).alias("label"),
                   F.coalesce(F.col("pubDate"), F.lit("")).alias("date"),
                   F.coalesce(F.col("link"), F.concat(F.lit("http://"), F.col("feed"))).alias("url")))
    return rec.withColumn("year", F.year(parse_date(F.col("date"))))


def feed_records(spark: SparkSession, path: str, limit: int | None, keywords: Sequence[str] | None = None,
                 label: str = "Real", whole_files: bool = False) -> DataFrame:              # S10
    rec = item_records(read_items(spark, path, whole_files), label)
    if keywords:
        rec = rec.where(any_keyword(F.col("text"), keywords))                               # T27
    if limit is not None:
        w = Window.partitionBy("source").orderBy("ord")
        rec = rec.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
    return rec


def land_posts(spark: SparkSession, sf: str, path: str) -> None:
    conv = table(spark, sf, "conversations")
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text",
                F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
                F.col("role").alias("query"), F.col("role").alias("handle")) \
        .write.mode("ignore").json(path)


def _capped(posts: DataFrame, key: str, limit: int) -> DataFrame:
    n_keys = posts.select(key).distinct().count()          # number of queries / handles: a parameter list
    cap = max(10, limit // max(n_keys, 1))
    w = Window.partitionBy(key).orderBy("id")
    p = (posts.where(F.length(F.trim(F.coalesce(F.col("text"), F.lit("")))) > 0)
         .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap))
    return p.orderBy(key, "id").limit(limit)


def search_records(spark: SparkSession, path: str, limit: int, label: str,
                   reason: str = "matched a misinformation search query") -> DataFrame:   # S11
    posts = spark.read.schema("id long, text string, created_at string, query string, handle string").json(path)
    p = _capped(posts, "query", limit)
    return p.select(squash_whitespace(F.col("text")).alias("text"), F.lit(label).alias("label"),
                    F.concat(F.lit("X search: "), F.col("query")).alias("source"), F.col("created_at").alias("date"),
                    F.concat(F.lit("post/"), F.col("id").cast("string")).alias("url"),
                    F.lit("search").alias("collection_method"), F.lit(reason).alias("label_reason"))


def timeline_records(spark: SparkSession, path: str, limit: int, label: str,
                     reason: str = "posted by a satire account") -> DataFrame:              # S12
    posts = spark.read.schema("id long, text string, created_at string, query string, handle string").json(path)
    p = _capped(posts, "handle", limit)
    return p.select(squash_whitespace(F.col("text")).alias("text"), F.lit(label).alias("label"),
                    F.concat(F.lit("X:@"), F.col("handle")).alias("source"), F.col("created_at").alias("date"),
                    F.concat(F.lit("post/"), F.col("id").cast("string")).alias("url"),
                    F.lit("timeline").alias("collection_method"), F.lit(reason).alias("label_reason"))


def deduplicate_records(records: DataFrame, order: str = "ord") -> DataFrame:              # D3
    """Collapse whitespace, drop empty texts, keep the first record of every text."""
    r = records.withColumn("text", squash_whitespace(F.col("text"))).where(F.length("text") > 0)
    return dedup_first(r.withColumn("source_rank", F.lit(0)).withColumn("row_ord", F.col(order)),
                       order=("source_rank", "row_ord")).drop("source_rank", "row_ord")
