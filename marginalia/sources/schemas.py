"""Explicit schemas of the raw records and of the outputs."""

POST = "struct<post_type:string,topic_id:bigint,post_id:bigint,poster_id:bigint,post_canonical:string,post_rendered:string>"
ITEM = f"struct<item_id:bigint,item_type:string,item_text:string,post_data:{POST}>"

#: A page of a category: the first one holds ``category``, later ones ``new_items``.
CATEGORY_PAGE = f"category_id bigint, page_no int, response struct<category:struct<category_name:string,items:array<{ITEM}>>,new_items:array<{ITEM}>,no_more_items:boolean>"
TOPIC_PAGE = "topic_id bigint, error_code string, response struct<topic:struct<posts_data:array<struct<post_canonical:string>>>>"
FORUM_PAGE = "category_id bigint, page_no int, no_more_topics boolean, response struct<topics:array<struct<topic_id:bigint,topic_title:string,category_name:string,last_post_time:bigint>>>"

RAW_ITEMS = "category_id bigint, pos int, item_id bigint, item_type string, item_text string, post " + POST
RAW_CATEGORIES = "category_id bigint, category_name string"
TOPIC_POSTS = "topic_id bigint, pos int, post_canonical string, error_code string"

PROBLEM = "struct<statement:string,post_id:bigint,topic_id:bigint,n:int,answer:int,choices:array<string>,section:int>"
#: ``problems`` stays JSON: an array of problems, or of an array for each section.
NESTED_SERIES = "name string, tests array<struct<id:bigint,name:string,year:string,sections:array<string>,problems:string,computational:boolean,type:string,count:int>>, count int"
