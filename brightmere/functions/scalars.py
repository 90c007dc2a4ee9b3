"""Column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
EMPTY_UUID = "00000000-0000-0000-0000-000000000000"
ORDER_STATUS = {
    1: "In process",
    2: "Approved",
    3: "Backordered",
    4: "Rejected",
    5: "Shipped",
    6: "Cancelled",
}
INVALID_STATUS = "** Invalid **"
MISSING_NUMBER = "*** ERROR ***"


def uuid_shape(digest: Column) -> Column:
    """32 hex digits as 8-4-4-4-12."""
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def key_text(*cols: Column) -> Column:
    """An injective text of a composite key: each part carries its length, NULL has none."""
    parts = []
    for c in cols:
        text = c.cast("string")
        tagged = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(tagged, F.lit("-")))
    return F.concat(*parts)


def surrogate_key(*cols: Column) -> Column:
    """A repeatable UUID-shaped key of the business key (one load run twice agrees)."""
    return uuid_shape(F.md5(key_text(*cols)))


def row_md5(df: DataFrame, cols: list[str] | None = None, null_token: str | None = None) -> DataFrame:
    """``df`` with ``md5`` over the columns joined by ``_``.

    NULLs are skipped, so rows that differ only in which column is NULL can agree;
    ``null_token`` writes that text for a NULL instead.
    """
    parts = [F.col(f"`{c}`").cast("string") for c in (cols or df.columns)]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return df.withColumn("md5", F.md5(F.concat_ws("_", *parts)))


def status_text(status: Column) -> Column:
    """The name of an order status code."""
    named = reduce(
        lambda chain, item: chain.when(status == item[0], item[1]),
        list(ORDER_STATUS.items())[1:],
        F.when(status == 1, ORDER_STATUS[1]),
    )
    return named.otherwise(INVALID_STATUS)


def line_total(price: Column, discount: Column, quantity: Column) -> Column:
    return F.coalesce(price * (1 - discount) * quantity, F.lit(0))


def order_number(order_id: Column) -> Column:
    """``SO`` and the id; a missing id shows as an error text."""
    return F.coalesce(F.concat(F.lit("SO"), order_id.cast("string")), F.lit(MISSING_NUMBER))


def total_due(subtotal: Column, tax: Column, freight: Column) -> Column:
    return F.coalesce(subtotal + tax + freight, F.lit(0))


def json_number(col: Column, path: str) -> Column:
    """A number inside a JSON text, NULL where it is absent or not a number."""
    return F.get_json_object(col, path).try_cast("double")


def split_part(col: Column, sep: str, index: int) -> Column:
    """Part ``index`` (from 0) of text split at the literal ``sep``; NULL beyond the end."""
    return F.get(F.split(col, f"\\Q{sep}\\E"), F.lit(index))


def fields(col: Column, sep: str, names: list[str]) -> list[Column]:
    """The first parts of split text under ``names``."""
    return [split_part(col, sep, i).alias(name) for i, name in enumerate(names)]


# A character that no XML document can hold, not even by its number.
NO_XML = "\ufffe"
# Java refuses an XPath expression of more than a hundred operators; a step by local name has five.
XPATH_STEPS = 19


def xml_fields(df: DataFrame, col: str, paths: dict[str, str]) -> DataFrame:
    """Add one text column per XML path; rows without a document are left out.

    A path is a list of element names, ``A/B/C``: matching is on local names, so a
    namespace prefix in the document does not matter, and the first match counts.
    A missing element gives NULL. Paths are looked up together, as many as an expression may
    have, so that a document is parsed once for about six paths.
    """
    present = df.where(F.col(col).isNotNull())
    if not paths:
        return present
    together: list[list[str]] = [[]]
    for steps in (path.split("/") for path in paths.values()):
        if together[-1] and sum(p.count("/*") for p in together[-1]) + len(steps) > XPATH_STEPS:
            together.append([])
        # As a text, the nodes that a path finds are the first of them.
        together[-1].append("".join(f"/*[local-name()='{step}']" for step in steps))

    def texts(found: list[str]) -> Column:
        whole = f"concat({f", '{NO_XML}', ".join(found)})" if len(found) > 1 else found[0]
        return F.split(F.xpath_string(F.col(col), F.lit(whole)), NO_XML)

    extracted = {name: F.nullif(F.get("_found", F.lit(i)), F.lit("")) for i, name in enumerate(paths)}
    return present.withColumn("_found", F.concat(*map(texts, together))).withColumns(extracted).drop("_found")


# The elements of a product catalogue description.
CATALOG_PATHS = {
    "Summary": "ProductDescription/Summary/p",
    "Manufacturer": "ProductDescription/Manufacturer/Name",
    "Copyright": "ProductDescription/Manufacturer/Copyright",
    "ProductURL": "ProductDescription/Manufacturer/ProductURL",
    "WarrantyPeriod": "ProductDescription/Features/Warranty/WarrantyPeriod",
    "WarrantyDescription": "ProductDescription/Features/Warranty/Description",
    "NoOfYears": "ProductDescription/Features/Maintenance/NoOfYears",
    "MaintenanceDescription": "ProductDescription/Features/Maintenance/Description",
    "Wheel": "ProductDescription/Features/wheel",
    "Saddle": "ProductDescription/Features/saddle",
    "Pedal": "ProductDescription/Features/pedal",
    "BikeFrame": "ProductDescription/Features/BikeFrame",
    "Crankset": "ProductDescription/Features/crankset",
    "PictureAngle": "ProductDescription/Picture/Angle",
    "PictureSize": "ProductDescription/Picture/Size",
    "ProductPhotoID": "ProductDescription/Picture/ProductPhotoID",
    "Material": "ProductDescription/Specifications/Material",
    "Color": "ProductDescription/Specifications/Color",
    "ProductLine": "ProductDescription/Specifications/ProductLine",
    "Style": "ProductDescription/Specifications/Style",
    "RiderExperience": "ProductDescription/Specifications/RiderExperience",
}


def first_present(df: DataFrame, preferred: str, fallback: str) -> Column:
    """``preferred`` where the frame has it and it is not empty, else ``fallback``."""
    if preferred not in df.columns:
        return F.col(fallback)
    return F.coalesce(F.nullif(F.col(preferred), F.lit("")), F.col(fallback))


def columns_front(df: DataFrame, front: list[str]) -> DataFrame:
    """The same columns with ``front`` first."""
    return df.select(*front, *[c for c in df.columns if c not in front])


def path_parts(date_text: Column) -> dict[str, Column]:
    """Folder parts of a ``yyyy-MM-dd`` text."""
    return {
        "year": F.substring(date_text, 1, 4),
        "month": F.substring(date_text, 6, 2),
        "folder": F.replace(F.substring(date_text, 1, 7), F.lit("-"), F.lit("/")),
    }
