"""Readers of stored inputs. Each returns rows of one documented shape; nothing is fetched."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalise_name
from .json_ranges import RANGE, json_records

PLACES = "array<struct<id:string,displayName:struct<text:string>,formattedAddress:string,websiteUri:string,businessStatus:string,internationalPhoneNumber:string,rating:double,userRatingCount:int,primaryType:string,location:struct<latitude:double,longitude:double>>>"
FI_COMPANY = (
    "struct<businessId:string,names:array<struct<name:string,type:string,endDate:string,registrationDate:string>>,mainBusinessLine:struct<type:string,descriptions:array<struct<languageCode:string,description:string>>>,"
    "addresses:array<struct<type:int,street:string,buildingNumber:string,postCode:string,co:string,endDate:string,postOffices:array<struct<city:string,languageCode:string>>>>,registeredEntries:array<struct<type:string,register:string,status:string,endDate:string>>,"
    "companySituations:array<struct<type:string,descriptions:array<struct<languageCode:string,description:string>>>>,companyForms:string,website:string,registrationDate:string,endDate:string,lastModified:string,status:string,tradeRegisterStatus:string>"
)


def read_pages(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """The page corpus: a table, or (path, html) of raw files; bytes that aren't UTF-8 become replacement characters."""
    if not raw:
        return spark.read.parquet(path)
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))


#: Keys under which a register dump has its companies, best first.
COMPANY_KEYS = ("companies", "results", "data", "items")


def read_register_json(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """One row a company: the file is an array, an object with one under companies, results, data or items, or objects one
    after another. businessId may be an object or a string. Files of any size are read by many tasks, by byte ranges."""
    rows = json_records(spark, path, COMPANY_KEYS, range_bytes=range_bytes).select(F.from_json("record", FI_COMPANY).alias("c")).select("c.*")
    own = F.coalesce(F.get_json_object("businessId", "$.value"), F.col("businessId"))
    return rows.withColumn("businessId", own).where("businessId is not null")


def folded_header(name: str) -> str:
    flat = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "_", flat).strip("_")


def header_mapping(columns: list[str], mapping: dict[str, str]) -> dict[str, list[str]]:
    """Field -> columns: a folded header that is a key of mapping, or else the longest key contained in the header."""
    out: dict[str, list[str]] = {}
    for c in columns:
        h = folded_header(c)
        key = h if h in mapping else max((k for k in mapping if k in h), key=len, default=None)
        if key:
            out.setdefault(mapping[key], []).append(c)
    return out


def by_header(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns by header; of several columns of one field the first non-empty; no column fits: no columns and no rows."""
    found = header_mapping(df.columns, mapping)
    if not found:
        return df.limit(0).select(*[F.lit(None).cast("string").alias(f) for f in dict.fromkeys(mapping.values())])
    return df.select(*[F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in cols]).alias(field) for field, cols in found.items()])


def read_by_header(spark: SparkSession, path: str, mapping: dict[str, str], sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    return by_header(spark.read.csv(path, header=True, sep=sep, encoding=encoding, escape='"'), mapping)


def read_register_persons(spark: SparkSession, path: str, wrapper: str | None = None, range_bytes: int = RANGE) -> DataFrame:
    """(record) as JSON text, of a nested person dump: an array, the first array of objects in an object (or the one under
    `wrapper`), or objects one after another; operators.register.register_persons picks the people."""
    return json_records(spark, path, None, wrapper, range_bytes).select("record")


def read_extracts(spark: SparkSession, path: str) -> DataFrame:
    """(business_id, text) of register extracts' texts, by the first id in each."""
    rows = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
    return rows.withColumn("business_id", F.nullif(F.regexp_extract("text", "\\b([0-9]{7}-[0-9])\\b", 1), F.lit(""))).where("business_id is not null").select("business_id", "text")


def read_api_captures(spark: SparkSession, path: str) -> DataFrame:
    """(venue_id, query_no, query, status, place) of stored places responses; a response without places gives no rows."""
    rows = spark.read.schema(f"venue_id bigint, query_no int, query string, status int, response struct<places:{PLACES}>").json(path)
    return rows.select("venue_id", "query_no", "query", "status", F.explode("response.places").alias("place"))


def read_verdicts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Judged names, by normalised name; rows without a usable name are left out. Confidence is high and the model
    `imported` unless given."""
    raw = spark.read.csv(path, header=True, escape='"')
    has = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select(
        normalise_name(F.col("harvested_string")).alias("name_norm"), F.trim("harvested_string").alias("name"), F.lower(F.trim("is_person")).isin("1", "true", "yes", "y").cast("int").alias("is_person"),
        F.nullif(F.trim("cleaned_name"), F.lit("")).alias("cleaned_name"), F.col("reason"), F.coalesce(F.nullif(has("confidence"), F.lit("")), F.lit("high")).alias("confidence"), F.coalesce(F.nullif(has("model"), F.lit("")), F.lit("imported")).alias("model"),
    )
    return rows.where("name_norm <> ''")
