"""Reading source tables. Column pruning and filter pushdown are left to Spark's file sources."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.joins import lookup_join
from tagloom.session import local_frame

FIELD_SEPARATOR = "\u0001"

# Columns of the web log table, in file order.
LOG_COLUMNS = ["id", "log_id", "remote_ip", "site_global_ticket", "site_global_session", "global_user_id",
               "cookie_text", "user_agent", "ref_url", "loc_url", "log_time"]

# Columns of the user, order and goods tables, in file order.
USER_COLUMNS = ["id", "siteid", "avatarimagefileid", "email", "username", "password", "salt", "registertime",
                "lastlogintime", "lastloginip", "memberrankid", "bigcustomerid", "lastaddressid", "lastpaymentcode",
                "gender", "birthday", "qq", "job", "mobile", "politicalface", "nationality", "validatecode",
                "pwderrcount", "source", "marriage", "money", "moneypwd", "isemailverify", "issmsverify",
                "smsverifycode", "emailverifycode", "verifysendcoupon", "canreceiveemail", "modified", "channelid",
                "grade_id", "nick_name", "is_blacklist"]
ORDER_COLUMNS = ["id", "siteid", "istest", "hassync", "isbackend", "isbook", "iscod", "notautoconfirm", "ispackage",
                 "packageid", "ordersn", "relationordersn", "memberid", "predictid", "memberemail", "addtime",
                 "synctime", "orderstatus", "paytime", "paymentstatus", "receiptconsignee", "receiptaddress",
                 "receiptzipcode", "receiptmobile", "productamount", "orderamount", "paidbalance", "giftcardamount",
                 "paidamount", "shippingamount", "totalesamount", "usedcustomerbalanceamount", "customerid",
                 "bestshippingtime", "paymentcode", "paybankcode", "paymentname", "consignee", "originregionname",
                 "originaddress", "province", "city", "region", "street", "markbuilding", "poiid", "poiname",
                 "regionname", "address", "zipcode", "mobile", "phone", "receiptinfo", "delayshiptime", "remark",
                 "bankcode", "agent", "confirmtime", "firstconfirmtime", "firstconfirmperson", "finishtime",
                 "tradesn", "signcode", "source", "sourceordersn", "onedaylimit", "logisticsmanner",
                 "aftersalemanner", "personmanner", "visitremark", "visittime", "visitperson", "sellpeople",
                 "sellpeoplemanner", "ordertype", "hasreadtaobaoordercomment", "memberinvoiceid", "taobaogroupid",
                 "tradetype", "steptradestatus", "steppaidfee", "depositamount", "balanceamount", "autocanceldays",
                 "isnolimitstockorder", "ccborderreceivedlogid", "ip", "isgiftcardorder", "giftcarddownloadpassword",
                 "giftcardfindmobile", "autoconfirmnum", "codconfirmperson", "codconfirmtime", "codconfirmremark",
                 "codconfirmstate", "paymentnoticeurl", "addresslon", "addresslat", "smconfirmstatus",
                 "smconfirmtime", "smmanualtime", "smmanualremark", "istogether", "isnotconfirm", "tailpaytime",
                 "points", "modified", "channelid", "isproducedaily", "couponcode", "couponcodevalue", "ckcode"]
GOODS_COLUMNS = ["id", "siteid", "istest", "hasread", "supportonedaylimit", "orderid", "cordersn", "isbook",
                 "cpaymentstatus", "cpaytime", "producttype", "productid", "productname", "sku", "price", "number",
                 "lockednumber", "unlockednumber", "productamount", "balanceamount", "couponamount", "esamount",
                 "giftcardnumberid", "usedgiftcardamount", "couponlogid", "activityprice", "activityid", "cateid",
                 "brandid", "netpointid", "shippingfee", "settlementstatus", "receiptorrejecttime", "iswmssku",
                 "scode", "tscode", "tsshippingtime", "status", "productsn", "invoicenumber", "expressname",
                 "invoiceexpressnumber", "postman", "postmanphone", "isnotice", "noticetype", "noticeremark",
                 "noticetime", "shippingtime", "lessordersn", "waitgetlesshippinginfo", "getlesshippingcount",
                 "outping", "lessshiptime", "closetime", "isreceipt", "ismakereceipt", "receiptnum",
                 "receiptaddtime", "makereceipttype", "shippingmode", "lasttimeforshippingmode",
                 "lasteditorforshippingmode", "systemremark", "tongshuaiworkid", "orderpromotionid",
                 "orderpromotionamount", "externalsalesettingid", "recommendationid", "hassendalertnum",
                 "isnolimitstockproduct", "hpregisterdate", "hpfaildate", "hpfinishdate", "hpreservationdate",
                 "shippingopporunity", "istimeoutfree", "itemshareamount", "lessshiptintime", "lessshiptouttime",
                 "cbsseccode", "points", "modified", "splitflag", "splitrelatecordersn", "channelid", "activityid2",
                 "pdorderstatus", "omsordersn", "couponcode", "couponcodevalue", "storeid", "storetype", "stocktype",
                 "o2otype", "brokeragetype", "ogcolor"]

TABLE_COLUMNS = {"users": USER_COLUMNS, "orders": ORDER_COLUMNS, "goods": GOODS_COLUMNS, "logs": LOG_COLUMNS}


def read_fields(spark: SparkSession, path: str, fields: Sequence[str], fmt: str = "parquet",
                as_text: bool = True) -> DataFrame:
    """The named fields of a table; only these columns are read. All are strings unless ``as_text`` is off."""
    source = spark.read.format(fmt).load(path)
    return source.select(*[F.col(f).cast("string").alias(f) if as_text else F.col(f) for f in fields])


def read_tags_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
                   partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                   partitions: int | None = None) -> DataFrame:
    """The tag table from a database, in parallel ranges when a partition column is given."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties)


def split_line(line: Column, separator: str, strict_compat: bool) -> Column:
    """Fields of a line; ``strict_compat`` forgets all empty fields at the end of the line."""
    if strict_compat:
        line = F.regexp_replace(line, f"{separator}+$", "")
    return F.split(line, separator)


def _file_ranks(lines: DataFrame) -> DataFrame:
    """``(name, rank)`` of the files behind a frame, in the order of their names; the driver lists them to plan the scan anyway."""
    names = sorted({re.sub("^file:/+", "file:/", name) for name in lines.inputFiles()})
    return local_frame(lines.sparkSession, list(zip(names, range(len(names)))), "name string, rank long")


def line_places(lines: DataFrame) -> DataFrame:
    """Text lines with their ``place``: a number of fixed width that grows with file name, block and line.

    Nine digits for the file, sixteen for the start of the block and ten for the line in it, so a hash aggregate can keep the
    greatest one in its buffer.
    """
    lines = lines.select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_file"),
                         F.col("_metadata.file_block_start").cast("decimal(16,0)").alias("_block"),
                         F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(10,0)").alias("_line"))
    ranked = lookup_join(lines, _file_ranks(lines), "_file", "name", "left", ["value", "_block", "_line"])
    rank = F.coalesce("rank", F.raise_error(F.lit("a file was added while it was read"))).cast("decimal(9,0)")
    place = rank * F.lit(Decimal(10**26)) + F.col("_block") * F.lit(Decimal(10**10)) + F.col("_line")
    return ranked.select("value", place.cast("decimal(38,0)").alias("place"))


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], strict_compat: bool = False) -> DataFrame:
    """Load ``\\x01``-separated lines as strings, one row per key (the first field).

    A line that lacks one field at the end gets an empty one, a line of any
    other length is dropped. Of several lines with one key the last in file
    order stays. Only keys and places are aggregated, by hash and on the map
    side first, so a hot key reaches its final task with one place per map
    task; the lines then meet the places that stay, without a sort.
    """
    n = len(columns)
    lines = line_places(spark.read.text(path))
    fields = lines.select(split_line(F.col("value"), FIELD_SEPARATOR, strict_compat).alias("f"), "place")
    padded = F.when(F.size("f") == n - 1, F.concat("f", F.array(F.lit("")))).otherwise(F.col("f"))
    whole = fields.where(F.size("f").isin(n - 1, n)).select(padded.alias("f"), "place")
    last = whole.groupBy(F.col("f")[0].alias("key")).agg(F.max("place").alias("place")).select("place")
    kept = whole.join(last.hint("shuffle_hash"), "place", "left_semi")
    return kept.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)])


def load_table(spark: SparkSession, name: str, lines: str, out: str, strict_compat: bool = False) -> DataFrame:
    """Load the lines of one of ``TABLE_COLUMNS`` into the Parquet table that the jobs read, and return it."""
    if name not in TABLE_COLUMNS:
        raise ValueError(f"no table {name!r}; known: {sorted(TABLE_COLUMNS)}")
    read_delimited(spark, lines, TABLE_COLUMNS[name], strict_compat).write.parquet(out)
    return spark.read.parquet(out)


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """``(label double, features vector)``; naming the feature count saves a pass over the data."""
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", features) if features else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Header-less separated text with a given schema, so nothing is inferred."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_homes(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated house sales."""
    return read_csv(spark, path, "mlsNum string, city string, sqFt double, bedrooms int, bathrooms int, garage int, "
                                 "age int, acres double, price double", "|")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user, item, rating, time``; the time is not kept."""
    return read_csv(spark, path, "userId int, itemId int, rating double, ts long", "\t").drop("ts")


TAG_SCHEMA = "id long, name string, rule string, level int, pid long"


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """The tag table from Parquet."""
    return spark.read.schema(TAG_SCHEMA).parquet(path)
