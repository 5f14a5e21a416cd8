"""Substring search over dimension keys from a table of three-character grams.

Each key is stored once under each gram of its digits, with the columns that searches
filter and return. A search reads the rows of one gram of the text and tests the key
that stands in them, so nothing is joined and nothing else is read: the grams' first
characters are partitions, and rows are sorted by gram inside the files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.operators.cuboids import Star

LENGTH = 3
GRAM, LEAD = "gram", "lead"
# The table of each searched key and the cuboid that holds the key once.
TABLES = {"product": "product_key_grams", "customer": "customer_key_grams", "store": "store_key_grams"}
CUBOIDS = {"product": "olap_sales_by_product", "customer": "olap_sales_by_customer_loc", "store": "olap_inv_by_store"}
COLUMNS = {"product": (), "customer": ("state", "city", "customer_type"), "store": ("state", "city")}


def gram_of(text: str) -> str | None:
    """A gram that every key with this text has; None where the text is too short, so that a search has to scan.

    % and _ stand for other characters, so a gram lies between them. A backslash
    takes their meaning away, which is left to the scan.
    """
    if "\\" in text:
        return None
    pieces = [p for p in re.split("[%_]", text.strip()) if len(p) >= LENGTH]
    return max(pieces, key=len)[:LENGTH].lower() if pieces else None


def postings(star: Star, searched: str) -> DataFrame:
    """Every key of the searched kind under each of its grams, once."""
    key = f"{searched}_key"
    keys = star.cuboid(CUBOIDS[searched]).where(F.col(key).isNotNull())
    if searched == "customer":
        # The cuboid's rows have a place; the type is the customer's own.
        typed = star.table("dim_customer").select(key, "customer_type")
        keys = keys.join(F.broadcast(typed) if star.is_small("dim_customer") else typed, key, "left")
    text = F.lower(F.col(key).cast("string"))
    starts = F.sequence(F.lit(1), F.length(text) - LENGTH + 1)
    grams = F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, F.lit(LENGTH))))
    long_enough = keys.where(F.length(text) >= LENGTH)
    return long_enough.select(key, *COLUMNS[searched], F.explode(grams).alias(GRAM)).withColumn(LEAD, F.substring(GRAM, 1, 1))


def keys_near(star: Star, searched: str, text: str) -> DataFrame | None:
    """Rows of all keys that may contain the text, each key once; None where the text has no gram."""
    gram = gram_of(text)
    if gram is None:
        return None
    found = star.table(TABLES[searched]).where((F.col(LEAD) == gram[0]) & (F.col(GRAM) == gram))
    return found.select(f"{searched}_key", *COLUMNS[searched])


BUILDERS = {table: (lambda star, s=searched: postings(star, s)) for searched, table in TABLES.items()}
OF_CUBE = {"sales": ("product_key_grams", "customer_key_grams"), "inventory": ("store_key_grams",)}
