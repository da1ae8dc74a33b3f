"""Typed process, contract and supplier tables from raw snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V

# Administrative levels as the source spells them, normalised.
LEVELS = ("NACIONAL", "TERRITORIAL", "CORPORACION AUTONOMA")


def field(content: Column, name: str) -> Column:
    return V.clean_text(F.get_json_object(content, f"$.{name}"))


def fields(raw: DataFrame, content: str, names: dict[str, str], kept: list[str]) -> DataFrame:
    """Fields of a JSON document as clean text, a column for each name, and the columns kept.

    A document is read once for all of them. Of a field said twice the first that
    is not null counts; such a document is written anew with each field once.
    """
    c, keys = F.col(content), F.json_object_keys(content)
    once = F.to_json(F.struct(*(F.get_json_object(c, f"$.{said}").alias(said) for said in names.values())))
    said = raw.select(*kept, F.when(F.size(keys) > F.size(F.array_distinct(keys)), once).otherwise(c).alias("__content"))
    said = said.select(*kept, F.json_tuple("__content", *names.values()).alias(*names))
    return said.select(*kept, *(V.clean_text(F.col(n)).alias(n) for n in names))


def processes(raw: DataFrame, content: str = "content") -> DataFrame:
    """The process columns; rows without a process id go (count them with rejected())."""
    kept = [x for x in ("row_id", "hash", "seen_at") if x in raw.columns]
    said = fields(raw, content, {
        "process_id": "id_del_proceso", "portfolio_id": "id_del_portafolio", "reference": "referencia_del_proceso", "entity_id": "nit_entidad", "entity_name": "entidad",
        "published_on": "fecha_de_publicacion_del", "modality": "modalidad_de_contratacion", "state": "estado_del_procedimiento", "awarded": "adjudicado",
    }, kept)
    out = said.select(
        "process_id", "portfolio_id", "reference", "entity_id", "entity_name", V.to_date(F.col("published_on")).alias("published_on"), "modality", "state", V.to_boolean(F.col("awarded")).alias("awarded"), *kept,
    )
    return out.where("process_id IS NOT NULL")


def contracts(raw: DataFrame, content: str = "content", ceiling=V.SCALE_CEILING) -> DataFrame:
    """The contract columns with supplier identity, territory and flags; rows without a contract id go."""
    kept = [x for x in ("row_id", "hash", "seen_at") if x in raw.columns]
    # a document's fields, and what its supplier follows from, are columns of their own: as one expression each was computed at every mention
    said = fields(raw, content, {
        "contract_id": "id_contrato", "link_key": "proceso_de_compra", "reference": "referencia_del_contrato", "entity_id": "nit_entidad", "entity_name": "nombre_entidad",
        "value": "valor_del_contrato", "signed_on": "fecha_de_firma", "state": "estado_contrato", "__type": "tipodocproveedor", "__bare": "documento_proveedor",
        "supplier_name": "proveedor_adjudicado", "is_group": "es_grupo", "admin_level": "orden", "__department": "departamento", "municipality": "ciudad",
    }, kept)
    said = said.where("contract_id IS NOT NULL").withColumns({"__type": V.normalized(F.col("__type")), "__bare": V.bare_number(F.col("__bare"))}).withColumn("__real", V.real_number(F.col("__bare")))
    out = said.select(
        "contract_id", "link_key", "reference", "entity_id", "entity_name", V.to_decimal(F.col("value")).alias("value"),
        V.to_date(F.col("signed_on")).alias("signed_on"), "state", F.coalesce("__type", F.lit("SIN TIPO")).alias("__kind"),
        V.without_check_digit(F.col("__type"), F.col("__real")).alias("__number"), "supplier_name",
        F.coalesce(V.normalized(F.col("is_group")) == "SI", F.lit(False)).alias("is_group"), admin_level(F.col("admin_level")).alias("admin_level"),
        V.normalized(F.col("__department")).alias("__department"), V.normalized(F.col("municipality")).alias("municipality"), *kept,
    )
    out = with_supplier(out).withColumn("out_of_scale", V.out_of_scale(F.col("value"), ceiling))
    return out.withColumnRenamed("__department", "department_name")


def with_supplier(df: DataFrame) -> DataFrame:
    """supplier_type and supplier_number from __kind and __number; a group without a document gets an identity of its own contract.

    provisional says so, and is null where there is no identity at all.
    """
    group = F.col("__number").isNull() & F.col("is_group")
    kind = F.when(F.col("__number").isNotNull(), F.col("__kind")).when(group, F.lit(V.JOINT_VENTURE))
    number = F.coalesce("__number", F.when(group, V.normalized(F.col("contract_id").cast("string"))))
    return df.withColumn("supplier_type", kind).withColumn("supplier_number", number).withColumn("provisional", F.col("supplier_type") == V.JOINT_VENTURE).drop("__kind", "__number")


def admin_level(c: Column) -> Column:
    n = V.normalized(c)
    return F.when(n.isin(*LEVELS), n)


def rejected(raw: DataFrame, field_name: str, content: str = "content") -> DataFrame:
    """How many rows have no identity."""
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(field(F.col(content), field_name).isNull()).alias("rejected"))


def one_per_process(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The last row of each process in the order of row_id, as awards of one process repeat it."""
    from .raw import latest

    return latest(df, ["process_id"], [F.desc(row_id)])


def linked(contracts: DataFrame, processes: DataFrame, row_id: str = "row_id") -> DataFrame:
    """contracts with process_id: the process whose portfolio is their link key.

    Of several processes of a portfolio the one first seen last wins: the
    largest of the smallest row ids.
    """
    first = processes.where("portfolio_id IS NOT NULL").groupBy("portfolio_id", "process_id").agg(F.min(row_id).alias("__first"))
    index = first.groupBy("portfolio_id").agg(F.max_by("process_id", F.struct("__first", "process_id")).alias("process_id"))
    return contracts.drop("process_id").join(index.withColumnRenamed("portfolio_id", "link_key"), "link_key", "left")


def link_summary(contracts: DataFrame) -> DataFrame:
    """One row: contracts, linked, orphans (a key without a process), without key, and the orphans' share of keys."""
    key, process = F.col("link_key").isNotNull(), F.col("process_id").isNotNull()
    out = contracts.agg(F.count(F.lit(1)).alias("contracts"), F.count_if(process).alias("linked"), F.count_if(key & ~process).alias("orphans"), F.count_if(~key).alias("without_key"))
    with_key = F.col("linked") + F.col("orphans")
    return out.withColumn("orphan_share", F.when(with_key > 0, F.col("orphans") / with_key))


def supplier_variants(contracts: DataFrame) -> DataFrame:
    """supplier_type, supplier_number, name and contracts with it."""
    named = contracts.where("supplier_number IS NOT NULL")
    return named.groupBy("supplier_type", "supplier_number", F.col("supplier_name").alias("name")).agg(F.count(F.lit(1)).alias("contracts"))


def suppliers(variants: DataFrame) -> DataFrame:
    """One row a supplier: main_name (the most frequent, then the first by alphabet), contracts, variants and provisional."""
    by = ["supplier_type", "supplier_number"]
    main = F.min_by("name", F.when(F.col("name").isNotNull(), F.struct(-F.col("contracts"), F.col("name"))))
    out = variants.groupBy(*by).agg(main.alias("main_name"), F.sum("contracts").alias("contracts"), F.count("name").alias("variants"))
    return out.withColumn("provisional", F.col("supplier_type") == V.JOINT_VENTURE)


def with_department(df: DataFrame, departments: DataFrame, name: str = "department_name") -> DataFrame:
    """department_code by normalised name, and the official name where there is one. departments has a few dozen rows."""
    small = F.broadcast(departments.select("code", F.col("name").alias("official"), V.normalized(F.col("name")).alias("__name")))
    out = df.withColumn("__name", V.normalized(F.col(name))).join(small, "__name", "left")
    return out.withColumn(name, F.coalesce("official", "__name")).withColumnRenamed("code", "department_code").drop("official", "__name")


def with_municipality(df: DataFrame, municipalities: DataFrame) -> DataFrame:
    """municipality_code by department and normalised name, as names repeat across departments. About a thousand rows."""
    table = municipalities.select(F.substring("code", 1, 2).alias("department_code"), V.normalized(F.col("name")).alias("__m"), F.col("code").alias("municipality_code"))
    out = df.withColumn("__m", V.normalized(F.col("municipality")))
    return out.join(F.broadcast(table), ["department_code", "__m"], "left").drop("__m")


def shared_names(municipalities: DataFrame) -> DataFrame:
    """Municipality names that several departments have."""
    named = municipalities.select(V.normalized(F.col("name")).alias("name"), F.substring("code", 1, 2).alias("department"))
    return named.groupBy("name").agg(F.countDistinct("department").alias("departments")).where("departments > 1")
