"""Key, checksum and lineage expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Surrogate keys must equal the ones stored in existing tables.
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# Model-name prefixes that do not become part of a key name.
LAYER_PREFIXES = ("euh__", "cur__", "dim__", "fct__", "eh__")

# Deployment stage -> ERP system id.
SYSTEM_IDS = {"dev": "D80", "tst": "A80", "pre": "B80", "prd": "P80"}


def name(column: str) -> Column:
    """Column by literal name; names like ``/BIC/ZCO_DOCNO`` or ``a.b`` need no quoting."""
    return F.col("`" + column.replace("`", "``") + "`")


def names(columns: Sequence[str]) -> list[Column]:
    return [name(c) for c in columns]


def besides(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """``columns`` without ``keys``; like Spark's own resolution, letter case does not count."""
    dropped = {k.lower() for k in keys}
    return [c for c in columns if c.lower() not in dropped]


def surrogate_key(columns: Sequence[str | Column]) -> Column:
    """md5 over the string forms of ``columns``; null has its own token, so null <> ''."""
    parts = [
        F.coalesce(
            (name(c) if isinstance(c, str) else c).cast("string"),
            F.lit(SURROGATE_NULL_TOKEN),
        )
        for c in columns
    ]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def surrogate_key_name(model: str) -> str:
    """Name of the key column of a model: layer prefix off, ``_sk`` on."""
    for prefix in LAYER_PREFIXES:
        if model.startswith(prefix):
            model = model[len(prefix):]
            break
    return f"{model}_sk"


def with_surrogate_key(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumn(surrogate_key_name(model), surrogate_key(columns))


def row_checksum(
    columns: Sequence[str],
    null_token: str = "",
    escape: bool = False,
) -> Column:
    """md5 over the string forms of ``columns`` joined by ``|``.

    The default treats null and '' alike and does not protect a ``|`` inside a value, as
    stored checksums were built that way. ``null_token`` and ``escape`` tell those apart.
    """
    parts = [name(c).cast("string") for c in columns]
    if escape:
        parts = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for p in parts]
    return F.md5(F.array_join(F.array(*parts), "|", null_token))


def detail_hash_key(parent_key: Column, detail_nr: Column) -> Column:
    """md5 of a parent hash followed by the detail number."""
    return F.md5(F.concat(parent_key, detail_nr.cast("string")))


def source_id(system_id: str | Column, client: str) -> Column:
    """``<system>_<client>``; null when the client is null."""
    system = F.lit(system_id) if isinstance(system_id, str) else system_id
    return F.concat(system, F.lit("_"), name(client))


def system_id_lookup(
    environment: Column,
    mapping: Mapping[str, str] = SYSTEM_IDS,
    default: str = "Unknown",
) -> Column:
    """System id of an environment name by exact match."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), environment), F.lit(default))


def key_suffix(column: str, length: int = 3) -> Column:
    """Last ``length`` characters of a key, used as partition key."""
    return F.right(name(column).cast("string"), F.lit(length))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key; a function of the key alone, so a key never changes bucket."""
    return F.pmod(F.xxhash64(*names(keys)), F.lit(buckets)).cast("int")


def coalesce_columns(source: str, target: str) -> Column:
    return F.coalesce(name(source), name(target))


def key_number(column: str, leading: int = 1) -> Column:
    """Numeric part of a key such as ``C1000001``; null when it is not a number."""
    text = name(column)
    return F.expr(f"try_cast(substring(`{column}`, {leading + 1}) as bigint)") if leading else text.try_cast("bigint")


def case_map(column: Column, mapping: Mapping[object, object], otherwise: Column | None = None) -> Column:
    """Branch per mapped value; ``otherwise`` defaults to null."""
    result = None
    for value, mapped in mapping.items():
        branch = column == F.lit(value)
        result = F.when(branch, F.lit(mapped)) if result is None else result.when(branch, F.lit(mapped))
    if result is None:
        raise ValueError("mapping is empty")
    return result if otherwise is None else result.otherwise(otherwise)
