"""Contact-log and user-snapshot operators: scans, normalisation, the pair generator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rambler.functions.phone import normalize_phone


def contacts_in_range(contacts: DataFrame, start: str, end: str) -> DataFrame:
    """Contact rows with ``start <= dt <= end`` (a plain column predicate: partition
    pruning and Parquet pushdown apply)."""
    return contacts.where(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def users_snapshot(users: DataFrame, dt: str) -> DataFrame:
    """One day of the user table with a phone number."""
    return users.where((F.col("dt") == F.lit(dt).cast("date")) & F.col("mobile_number").isNotNull())


def users_in_regions(users: DataFrame, region_ids) -> DataFrame:
    """``region_ids`` contains any of the ids as a substring (``LIKE '%id%'``, OR-ed).

    A substring test, so id ``1`` also matches ``12`` — kept as the modelled system does it.
    None or an empty list means no filter.
    """
    if not region_ids:
        return users
    cond = reduce(lambda a, b: a | b, [F.col("region_ids").contains(str(r)) for r in region_ids])
    return users.where(cond)


def distinct_contacts(contacts: DataFrame) -> DataFrame:
    """P1 + P2 + A6: normalised phone, invalid ones dropped, distinct ``(phone_number, user_id)``."""
    return (contacts.select(normalize_phone("phone_number").alias("phone_number"), "user_id")
            .where(F.col("phone_number") != "")
            .dropDuplicates(["phone_number", "user_id"]))


def valid_users(users: DataFrame) -> DataFrame:
    """P1 + P2 on the user side: ``(mobile_number, id)`` with a valid number."""
    return (users.select(normalize_phone("mobile_number").alias("mobile_number"), "id")
            .where(F.col("mobile_number") != ""))


def phone_pairs(contacts: DataFrame, users: DataFrame, start: str, end: str, user_date: str,
                region_ids=None) -> DataFrame:
    """``(src_number, dest_number)`` = (owner's phone, contact's phone), self pairs dropped.

    Inner equi-join on ``user_id = id``; no distinct afterwards (each contact is already distinct).
    """
    c = distinct_contacts(contacts_in_range(contacts, start, end))
    u = valid_users(users_in_regions(users_snapshot(users, user_date), region_ids))
    return (c.join(u, c.user_id == u.id)
            .where(F.col("mobile_number") != F.col("phone_number"))
            .select(F.col("mobile_number").alias("src_number"),
                    F.col("phone_number").alias("dest_number")))
