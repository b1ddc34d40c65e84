"""Left joins with the master tables.

No join carries a broadcast hint: Spark broadcasts a master whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (statically or, with adaptive execution, at run time) and otherwise sorts and
merges, splitting skewed fact keys. A master that outgrows memory therefore costs time, not the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import or_na
from tracklayer.layouts import NA


def one_per_key(master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A master without duplicate keys: the greatest row of each survives, so a left join cannot fan out."""
    rest = [c for c in master.columns if c not in keys]
    if not rest:
        return master.select(*keys).distinct()
    best = master.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))


def lookup(
    facts: DataFrame,
    master: DataFrame,
    on: Sequence[tuple[Column, str]],
    take: dict[str, str],
    null_as_sentinel: bool = False,
    single: bool = False,
) -> DataFrame:
    """Left join on ``fact expression = master column`` pairs, adding ``take`` (master column -> new name).

    With ``null_as_sentinel`` a NULL master key matches a fact key that holds the sentinel. Duplicate master keys
    repeat the fact row, unless ``single`` keeps only the greatest master row of each key.
    """
    names = [f"_m{i}" for i in range(len(on))]
    keys = [(or_na(m) if null_as_sentinel else F.col(m)).alias(n) for (_, m), n in zip(on, names)]
    right = master.select(*keys, *(F.col(c).alias(n) for c, n in take.items()))
    if single:
        right = one_per_key(right, names)
    condition = [expr == F.col(n) for (expr, _), n in zip(on, names)]
    return facts.join(right, condition, "left").drop(*names)


def with_status(
    facts: DataFrame,
    status: DataFrame,
    kind: Column | str = "cstattype",
    code: Column | str = "cstatcode",
    single: bool = False,
) -> DataFrame:
    """Status group and description by (type, code)."""
    kind, code = (F.col(c) if isinstance(c, str) else c for c in (kind, code))
    take = {"cstatgroup": "stat_cstatgroup", "cstatdesc": "stat_cstatdesc"}
    return lookup(facts, status, [(kind, "cstattype"), (code, "cstatcode")], take, single=single)


def fallback(preferred: Column | str, other: Column | str) -> Column:
    """The preferred key, or the other where the preferred one holds the sentinel."""
    preferred, other = (F.col(c) if isinstance(c, str) else c for c in (preferred, other))
    return F.when(preferred == NA, other).otherwise(preferred)


def with_customer(
    facts: DataFrame, customer: DataFrame, area: Column | str, code: Column | str, single: bool = False
) -> DataFrame:
    """Company group by (area, customer code); NULL master keys match the sentinel."""
    area, code = (F.col(c) if isinstance(c, str) else c for c in (area, code))
    keys = [(area, "carea"), (code, "ccustcode")]
    return lookup(facts, customer, keys, {"ccompgrp": "cust_ccompgrp"}, null_as_sentinel=True, single=single)


def with_pack(
    facts: DataFrame,
    pack: DataFrame,
    product: Column | str,
    mode: Column | str,
    kind: Column | str,
    single: bool = False,
) -> DataFrame:
    """Product names by (product, mode, pack type); NULL master keys match the sentinel."""
    product, mode, kind = (F.col(c) if isinstance(c, str) else c for c in (product, mode, kind))
    take = {c: f"pack_{c}" for c in ("cprodparent", "cprodcommname", "csubprdcommname", "cprodgroup")}
    keys = [(product, "cprodcode"), (mode, "csubprdcd"), (kind, "cpacktype")]
    return lookup(facts, pack, keys, take, null_as_sentinel=True, single=single)


def with_group_name(facts: DataFrame, group: DataFrame, single: bool = False) -> DataFrame:
    """Group name through the company group looked up before."""
    return lookup(facts, group, [(F.col("cust_ccompgrp"), "ccompgrp")], {"ccompname": "cgrpname"}, single=single)


def enrich_shipment(
    facts: DataFrame,
    customer: DataFrame,
    pack: DataFrame,
    group: DataFrame,
    field: Callable[[str], Column] = F.col,
    single: bool = False,
) -> DataFrame:
    """Customer, product and group columns of a shipment or client-detail frame.

    ``field`` maps a column name to its expression, so that a record can be enriched while still encoded.
    """
    area = fallback(field("cbtparea"), field("corgarea"))
    code = fallback(field("cbtpcode"), field("ccustcode"))
    out = with_customer(facts, customer, area, code, single)
    out = with_pack(out, pack, field("cprodcode"), field("cmode"), field("cpacktype"), single)
    return with_group_name(out, group, single)


def enrich_pickup(facts: DataFrame, customer: DataFrame, group: DataFrame, single: bool = False) -> DataFrame:
    """Company group and its name on pickup calls, by the raw area and customer code."""
    return with_group_name(with_customer(facts, customer, "carea", "ccustcode", single), group, single)
