"""Schemas of what is exchanged: manifests, figures, questions, call logs, runs. Reads never infer."""

TOC = "array<struct<level:int,title:string,page:int>>"
SECTION = "struct<file:string,heading:string,level:int,page_start:int,page_end:int,pages_from:string,page_end_from:string,command:string,entity:string,breadcrumb:string,confidence:string,chars:int>"
MANIFEST = (
    "source_pdf string, title string, slug string, page_count int, doc_id string, version string, version_and_later boolean, extractor string, "
    f"toc {TOC}, attribution struct<status:string,command_level:int,chosen_by:string>, sections array<{SECTION}>, full_md_chars int, schema_version int, "
    "converter struct<script:string,extractor:string,extractor_version:string,converted_at:string,owns_breadcrumbs:boolean>, _bad string"
)
FIGURE = "struct<id:string,page:int,bbox:array<double>,fingerprint:string,file:string,caption:string,labels:string,section:string,link:string,width:int,height:int,ocr:string,description:string>"
FIGURES = f"slug string, source_pdf string, generator string, dpi int, max_px int, figures array<{FIGURE}>, _bad string"
ANSWER = "struct<slug:string,file:string,collection:string,doc_id:string,version:string,quote:string>"
QUESTION = f"id string, kind string, question string, answers array<{ANSWER}>, document string, version string, collection string, ask string, gold string, note string"
CALL = "t timestamp, tool string, args map<string,string>, sections array<bigint>, refs array<array<string>>, chars bigint, ms double, error boolean, images int, client string, token_id string"
PINS = "map<string,string>"
SUPERSEDED = "array<struct<file:string,superseded_by:string>>"
