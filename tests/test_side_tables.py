from quillon.operators.pages import page_tables
from quillon.operators.sentences import full_rows, sentence_tables, unmatched_links

PAGE = "id string, title string, redirect string, disambiguation boolean, categories array<string>, sections array<struct<text:string,title:string,level:int>>, article string, links array<struct<text:string,start_pos:int,end_pos:int,title:string,id:string>>"


def tables(spark):
    links = [("Mill", 4, 8, "Mill", "7"), ("Tower", 12, 17, None, None), ("x", None, 3, "Mill", None), ("over", 6, 14, "Mill", "7")]
    pages = spark.createDataFrame([("1", "Home", None, False, ["c", None], [("t", "h", 2)], "The Mill. A Tower.", links), ("2", None, "Home", True, None, None, None, None)], PAGE)
    kind = "id string, sentences array<struct<start_pos:int,end_pos:int,paragraph_index:int>>"
    return pages, spark.createDataFrame([("1", [(0, 9, 0), (10, 18, 0)]), ("2", None), ("9", [(0, 1, 0)])], kind)


def test_full_rows(spark):
    pages, sentences = tables(spark)
    known = spark.createDataFrame([("Mill", "m", "MILL"), ("Home", "h", "HOME")], "title string, id_ll string, title_ll string")
    rows = full_rows(pages, sentences, known)
    a, b = sorted(rows.collect(), key=lambda r: r["_id"])
    assert (a["_id"], a.id_ll, a.title_ll, a.len_char, a.len_tokens, a.len_links, a.len_links_ll) == ("1_0", "h", "HOME", 9, 3, 1, 1)
    assert a.links[0].id_ll == "m" and a.links[0].text_lower == "mill" and (b.len_links, b.len_links_ll, b.links[0].id_ll) == (1, 0, None)
    found = sentence_tables(rows)
    assert len(found) == 16 and found["links_text_lower"].count() == 2 and found["title_start_end"].columns == ["title", "start_pos", "end_pos", "_id"]


def test_page_tables_and_unmatched_links(spark):
    pages, sentences = tables(spark)
    found = page_tables(pages)
    assert len(found) == 12 and found["links_title"].count() == 3 and found["categories"].count() == 1 and found["redirect"].count() == 1
    assert [(r.id, [tuple(x) for x in r.links]) for r in unmatched_links(pages, sentences).collect()] == [("1", [(6, 14)])]
