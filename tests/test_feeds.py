"""Feed documents as they come: RSS 2.0, RSS 1.0, Atom, fragments; the stream against the batch form."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp.plans.base import combined
from veracorp.session import shared_dir
from veracorp.sources import feeds as FD
from veracorp.streaming import streams as ST

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE rss [<!ENTITY own "thing">]>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="urn:dc">
 <channel><title>The channel</title><link>http://channel</link>
  <!-- <item><title>no item</title></item> -->
  <item>
   <title>A &quot;q&quot; &#39;x&#39; &amp;&apos; &#8217;&#x27;</title>
   <description><![CDATA[<p>bold & more</p> </item> &quot;]]></description>
   <link> http://a?x=1&amp;y=2 </link><content:encoded>long form</content:encoded><dc:date>2020</dc:date>
   <pubDate>Mon, 06 Apr 2020 10:00:00 +0000</pubDate>
  </item>
  <item a="1"><title type="html">second</title><description/></item>
 </channel>
</rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
 <entry><title type="html">atom</title><link rel="self" href="http://no"/><link rel="alternate" href="http://yes"/>
 <summary>the summary</summary><published>2020-01-02</published><updated>2021-01-02</updated></entry>
 <entry><title>only content</title><content>inner</content><updated>2021-05-06</updated><link href="http://plain"/></entry></feed>"""
RDF = '<rdf:RDF xmlns:rdf="r"><channel><title>c</title></channel><item rdf:about="u"><title>rss one</title></item></rdf:RDF>'


def items(spark, *docs):
    got = FD.feed_items(spark.createDataFrame([(d,) for d in docs], "value string"))
    return [(r.title, r.description, r.link, r.pubDate) for r in got.collect()]


def test_rss_with_entities_cdata_attributes_comments_and_namespaces(spark):
    assert items(spark, RSS) == [("A \"q\" 'x' &' ’'", '<p>bold & more</p> </item> &quot;', "http://a?x=1&y=2", "Mon, 06 Apr 2020 10:00:00 +0000"),
                                 ("second", "", None, None)]


def test_atom_and_rss_one(spark):
    assert items(spark, ATOM, RDF) == [("atom", "the summary", "http://yes", "2020-01-02"), ("only content", "inner", "http://plain", "2021-05-06"),
                                       ("rss one", None, None, None)]


def test_fragments_and_undeclared_prefixes(spark):
    assert items(spark, "<item><title>1</title></item><item><title>2</title></item><entry><title>3</title></entry>",
                 '<x:item x:about="u"><x:title>4</x:title></x:item>') == [(t, None, None, None) for t in "1234"]


def test_documents_that_are_no_xml(spark):
    assert items(spark, "<item><title>a&nbsp;b &hellip; c & d &amp; e</title></item>", "<item><title>x\x0by\x00z</title></item>",
                 "<item><title>broken", "plain", "", None) == [("a b … c & d & e", None, None, None), ("x y z", None, None, None)]
    bad = FD.malformed(spark.createDataFrame([(d,) for d in ("<item><title>broken", RSS, "plain", None)], "value string"))
    assert [r.value for r in bad.collect()] == ["<item><title>broken"]


def test_whole_files_of_several_lines(spark, tmp_path):
    for name, doc in (("a.xml", RSS), ("b.xml", ATOM)):
        (tmp_path / name).write_text(doc)
    rec = FD.feed_records(spark, str(tmp_path), limit=None, whole_files=True).collect()
    assert sorted(r.text for r in rec) == ["A \"q\" 'x' &' ’'. <p>bold & more</p> </item> &quot;", "atom. the summary", "only content. inner", "second"]
    assert {r.text: r.year for r in rec}["atom. the summary"] == 2020


def test_landed_items_come_back_as_they_went(spark):
    root = shared_dir(spark, "landed")
    docs = combined(spark, SF_SMALL)
    FD.land_feed(docs, f"{root}/items")
    got = {r.ord: (r.title, r.description) for r in FD.read_items(spark, f"{root}/items").collect()}
    want = {}
    for r in docs.collect():
        head, _, rest = r.text.partition("\n")
        want[r.doc_id] = (head, rest)
    assert got == want


def _land(tmp_path, n, *values):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{n}.txt").write_text("".join(v.replace("\n", " ") + "\n" for v in values))


def _item(ord_, text, feed="f"):
    return f"<item><title>{text}</title><feed>{feed}</feed>{'' if ord_ is None else f'<ord>{ord_}</ord>'}</item>"


def test_stream_keeps_one_record_per_text_across_restarts(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]

    def step():
        progress = ST.feed_dedup_stream(spark, *where)
        return progress, sorted((r.ord, r.text) for r in spark.read.parquet(where[1]).collect())

    _land(tmp_path, 1, _item(5, "b"), _item(3, "a"), _item(2, "b"), _item(9, "c &quot;x&quot;"))
    progress, got = step()
    assert got == [(2, "b"), (3, "a"), (9, 'c "x"')]
    _land(tmp_path, 2, _item(1, "a"), _item(8, "d"), _item(7, "d"), _item(0, "c  \"x\""))   # late copies of a and c
    progress, got = step()
    assert got == [(2, "b"), (3, "a"), (7, "d"), (9, 'c "x"')]
    assert sum(p["numInputRows"] for p in progress) == 4       # the second run reads the new file alone
    state = [p["stateOperators"][0] for p in progress if p["numInputRows"]][-1]
    assert state["numRowsTotal"] == 4 and state["numRowsUpdated"] == 1   # one new digest; the others are only looked up
    assert "rocksdbGetCount" in state["customMetrics"]
    _, got = step()                                            # nothing new
    assert len(got) == 4


def test_work_of_a_micro_batch_does_not_grow_with_what_came_before(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    gets = []
    for n in range(3):
        _land(tmp_path, n, *[_item(100 * n + i, f"text {n} {i}") for i in range(40)], _item(10**6, "text 0 0"))
        progress = ST.feed_dedup_stream(spark, *where)
        gets.append([p["stateOperators"][0]["customMetrics"]["rocksdbGetCount"] for p in progress if p["numInputRows"]][-1])
    assert max(gets) <= 2 * min(gets)
    assert spark.read.parquet(where[1]).count() == 120


def test_stream_equals_the_batch_form(spark, tmp_path):
    root = shared_dir(spark, "st3-test")
    docs = combined(spark, SF_SMALL)
    again = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 100000))      # every text twice
    FD.land_feed(again, f"{root}/items")
    cols = ["source", "ord", "text", "date", "url", "year"]
    batch = FD.deduplicate_records(FD.feed_records(spark, f"{root}/items", limit=None)).select(*cols)
    ST.feed_dedup_stream(spark, f"{root}/items", f"{root}/out", f"{root}/checkpoint")
    assert sorted(map(tuple, spark.read.parquet(f"{root}/out").select(*cols).collect())) == sorted(map(tuple, batch.collect()))


def test_null_orders_come_first(spark, tmp_path):
    _land(tmp_path, 1, _item(1, "t", "g"), _item(None, "t", "f"), _item(0, "t", "e"))
    where = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    ST.feed_dedup_stream(spark, *where)
    assert [(r.ord, r.source) for r in spark.read.parquet(where[1]).collect()] == [(None, "f")]
