"""Explicit schemas of the records; dumps are never inferred."""

from __future__ import annotations

LINK = "struct<text:string,start_pos:int,end_pos:int,title:string,id:string>"
PAGE = (
    "id string, title string, redirect string, disambiguation boolean, lang string, article string, infobox string, "
    "categories array<string>, sections array<struct<text:string,start_pos:int,end_pos:int,title:string,level:int>>, "
    f"links array<{LINK}>, external_links array<struct<text:string,start_pos:int,end_pos:int,url:string>>"
)
RAW_PAGE = "id string, title string, ns string, redirect string, markup string"
PARSED_PAGE = (
    "id string, title string, redirect string, disambiguation boolean, article string, infobox string, categories array<string>, "
    "sections array<struct<text:string,start_pos:int,end_pos:int,title:string,level:int>>, "
    "links array<struct<text:string,start_pos:int,end_pos:int,title:string>>, "
    "external_links array<struct<text:string,start_pos:int,end_pos:int,url:string>>, error string"
)
LANGLINK = "ll_from string, ll_lang string, ll_title string"
