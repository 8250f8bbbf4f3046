"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

#: Landed raw responses: the input contract of every reader.
RAW_RESPONSE = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("feed", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

LISTING_ENTRY = (
    "struct<id:string,label:string,title:string,updated:string,timeUnit:string,firstPeriod:string,"
    "lastPeriod:string,description:string,source:string,note:variant,subjectCode:string,"
    "paths:string,discontinued:variant,links:variant,variableNames:array<string>>"
)
KPI = (
    "struct<id:string,title:string,description:string,is_divided_by_gender:variant,"
    "municipality_type:string,publication_date:string,prel_publication_date:string,"
    "publ_period:variant,has_ou_data:variant,operating_area:string,perspective:string,"
    "auspice:string>"
)
AREA = "struct<id:string,title:string,type:string>"
UNIT = "struct<id:string,title:string,municipality:string>"
OBSERVATION = (
    "struct<kpi:string,period:int,municipality:string,ou:string,"
    "values:array<struct<gender:string,value:double,isdeleted:boolean>>>"
)

STATE = T.StructType(
    [
        T.StructField("provider_code", T.StringType()),
        T.StructField("dataset_code", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("source_updated_at", T.TimestampType()),
        T.StructField("last_fetched_at", T.TimestampType()),
        T.StructField("has_error", T.BooleanType()),
    ]
)

PROVIDER = (
    "struct<code:string,label:map<string,string>,description:map<string,string>,"
    "country_code:string,website:string,extension:variant,"
    "harvest:struct<adapter:string,languages:array<string>,rate_limit:double,"
    "config:struct<base_api_url:string,database_ids:array<string>,"
    "extension:struct<base_web_url:string,cell_limit:variant,max_concurrency:variant>>>>"
)

IDENTITY = "struct<provider_code:string,dataset_code:string,language:string>"
CONTACT = (
    "struct<name:string,organization:string,mail:string,phone:string,raw:string,"
    "extension:map<string,variant>>"
)
DATASET_DOC = (
    f"struct<identity:{IDENTITY},label:string,description:string,updated:string,"
    "next_release:string,time_unit:string,first_period:string,last_period:string,"
    "discontinued:boolean,source_url:string,doc_url:string,extension:variant>"
)
CATEGORY = (
    "struct<index:map<string,int>,label:map<string,string>,child:map<string,array<string>>,"
    "coordinates:map<string,array<double>>,"
    "unit:map<string,struct<label:string,symbol:string,position:string,decimals:int,extension:variant>>,"
    "note:map<string,array<string>>,extension:variant>"
)
METADATA_DOC = (
    f"struct<identity:{IDENTITY},id:array<string>,"
    f"dimension:map<string,struct<label:string,category:{CATEGORY},note:array<string>,"
    "extension:variant,link:variant>>,"
    "role:struct<time:array<string>,geo:array<string>,metric:array<string>>,"
    "subject:struct<code:string,label:string,extension:variant>,"
    "paths:array<struct<path:array<struct<code:string,label:string,extension:variant>>,extension:variant>>,"
    "official_statistics:boolean,source:string,note:array<string>,"
    "contact:array<struct<raw:string,mail:string,name:string,phone:string,organization:string,extension:variant>>,"
    "metadata_url:string,retrieval:struct<type:string,config:variant>,extension:variant>"
)
DOCUMENT_PAIR = f"struct<dataset:{DATASET_DOC},metadata:{METADATA_DOC}>"
