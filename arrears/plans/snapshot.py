"""The snapshot chain: ``Base`` (M1, open contracts) and ``Base360`` (M2,
the daily snapshot with its derived columns and its insert / update /
withdrawal maintenance)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.operators.joins import reduce_by_keys, snapshot_id

MONEY = "decimal(19,4)"
OPEN = "A"

SNAPSHOT_KEY = ["id_devedor", "id_titulo", "data"]

# Columns Base360 updates on a re-run of the same day, and the six it
# compares to decide (D17: plan and due date are updated but not compared).
BASE360_SET = ["plano", "numero_parcela", "data_inclusao", "data_vencimento", "dias_em_atraso",
               "faixa_atraso", "risco", "saldo_vencido", "valor_regularizacao", "faixa_valor"]
BASE360_COMPARE_NUM = ["numero_parcela", "dias_em_atraso", "risco", "saldo_vencido",
                       "valor_regularizacao"]
BASE360_COMPARE_DATE = ["data_inclusao"]


def open_instalments(parcelas: DataFrame, as_of, parcelas_info: DataFrame | None = None) -> DataFrame:
    """A1 + A2: open instalments (``id_situacao_parcela = 'A'``) per contract.

    First number, smallest amount, total balance (risco), overdue balance
    (due strictly before ``as_of``'s day; NULL when none, not 0), first
    due date, last inclusion and last reopening date.  ``parcelas_info``
    (``id_parcela``, ``data_reabertura``) is left-joined when given;
    otherwise ``parcelas`` carries ``data_reabertura``.

    Every aggregate is decomposable, so Spark combines map-side before the
    shuffle on ``id_titulo``: a contract with a third of all instalments
    costs one partial row per input partition.
    """
    p = parcelas.filter(F.col("id_situacao_parcela") == F.lit(OPEN))
    if parcelas_info is not None:
        p = p.join(parcelas_info.select("id_parcela", "data_reabertura"), "id_parcela", "left")
    midnight = X.date_lit(as_of).cast("timestamp_ntz")
    v = F.col("valor_principal").cast(MONEY)
    return (p.groupBy("id_titulo").agg(
        F.min("numero_parcela").alias("numero_parcela"),
        F.min(v).alias("valor_principal"),
        X.money_sum(v).alias("risco"),
        X.money_sum(F.when(F.col("data_vencimento") < midnight, v)).alias("saldo_vencido"),
        F.min("data_vencimento").alias("data_vencimento"),
        F.max("data_inclusao").alias("data_inclusao"),
        F.max("data_reabertura").alias("data_reabertura"),
    ))


def base_snapshot(open_inst: DataFrame, titulos: DataFrame, devedores: DataFrame,
                  carteiras: DataFrame, titulos_info: DataFrame | None = None,
                  escob: DataFrame | None = None, propensao: DataFrame | None = None,
                  produtos: DataFrame | None = None, open_keys: DataFrame | None = None) -> DataFrame:
    """M1: one row per open contract with debtor, portfolio, product and
    normalised score.

    The contract-keyed sides (instalments, contract, extra info, the two
    score tables) are joined first, all on ``id_titulo`` -- Spark shuffles
    each once on that key and the sort-merge joins share the partitioning.
    With ``open_keys``, the filtered scan of open instalments, these sides are
    first reduced to its contracts (J15): Spark drops their other rows by a
    bloom filter before it shuffles them.  Then one shuffle on ``id_devedor`` for the debtor, and the
    portfolio / product dimensions are left to Spark to broadcast when small.
    """
    t_cols = ["id_titulo", "id_devedor", "numero_contrato", "plano"]
    t_cols += [c for c in ("id_carteira", "id_produto") if c in titulos.columns]
    def reduced(side: DataFrame) -> DataFrame:
        return side if open_keys is None else reduce_by_keys(side, open_keys, "id_titulo")

    df = open_inst.join(reduced(titulos.select(*t_cols)), "id_titulo", "inner")
    if titulos_info is not None:
        info = titulos_info.select("id_titulo", "valor_contrato_atualizado", "area_negocio",
                                   "codigo_cluster_score")
        df = df.join(reduced(info), "id_titulo", "left")
    else:
        df = df.withColumns({"valor_contrato_atualizado": F.lit(None).cast(MONEY),
                             "area_negocio": F.lit(None).cast("string"),
                             "codigo_cluster_score": F.lit(None).cast("string")})
    score_cols = [F.col("codigo_cluster_score")]
    for name, tbl in (("_esc", escob), ("_prop", propensao)):
        if tbl is not None:
            df = df.join(reduced(tbl.select("id_titulo", F.col("cluster").alias(name))), "id_titulo", "left")
            score_cols.append(F.col(name))
    d_cols = ["id_devedor", "cnpj_cpf", "razao_social_nome"]
    d_cols += [c for c in ("id_carteira",) if c in devedores.columns and c not in df.columns]
    df = df.join(devedores.select(*d_cols), "id_devedor", "inner")
    df = df.join(carteiras.select("id_carteira", "codigo_referencia", "carteira"),
                 "id_carteira", "inner")
    prod = []
    if produtos is not None:
        df = df.join(produtos.select("id_produto", "produto"), "id_produto", "inner")
        prod = ["produto"]
    return df.select(
        "codigo_referencia", "carteira", *prod,
        X.score_code(*score_cols).alias("cluster"),
        "id_devedor", "cnpj_cpf", "id_titulo", "numero_contrato", "razao_social_nome", "plano",
        "numero_parcela",
        F.coalesce("data_reabertura", "data_inclusao").alias("data_inclusao"),
        "data_vencimento", "risco", "saldo_vencido",
        F.col("valor_contrato_atualizado").cast(MONEY).alias("valor_regularizacao"),
        "area_negocio",
    )


def base360_derive(base: DataFrame, as_of) -> DataFrame:
    """M2 derivation (F9): product line, days overdue, value band, delay
    band, computed in one projection (later columns use earlier ones), plus
    the snapshot day and its stable id.  D16: the derived columns go in at
    insert time."""
    day = X.date_lit(as_of)
    df = base.withColumns({
        "data": day,
        "sub_produto": X.sub_product("area_negocio"),
        "dias_em_atraso": X.days_between("data_vencimento", X.ts_lit(as_of)),
        "faixa_valor": X.value_band("valor_regularizacao", "risco"),
    })
    df = df.withColumn("faixa_atraso", X.delay_band("sub_produto", "dias_em_atraso"))
    df = df.withColumn("id_base", snapshot_id("id_devedor", "id_titulo", "data"))
    prod = ["produto"] if "produto" in base.columns else []
    return df.select("id_base", "data", "codigo_referencia", "carteira", *prod, "sub_produto",
                     "cluster", "id_devedor", "cnpj_cpf", "id_titulo", "numero_contrato",
                     "razao_social_nome", "plano", "numero_parcela", "data_inclusao",
                     "data_vencimento", "dias_em_atraso", "faixa_atraso", "risco",
                     "saldo_vencido", "valor_regularizacao", "faixa_valor",
                     F.lit(None).cast("int").alias("id_retirada"))


def base360_apply(target: DataFrame, staged: DataFrame, as_of, mark: bool = True,
                  source_flag: bool = False) -> DataFrame:
    """M2 maintenance on the partitions ``data >= as_of's day`` (the only
    ones a run can change): K3 insert absent, K4 update the ten columns
    where any of the six compared ones differ (X8: NULL compares as 0 /
    1900-01-01), K5 flag rows no longer in the snapshot as withdrawn
    (``id_retirada = 1``).

    One full outer join on the snapshot key does all three; the result is
    the new content of the touched day partitions, to be written with
    dynamic partition overwrite (the rest of the table is not read).
    """
    day = X.date_lit(as_of)
    t = target.filter(F.col("data") >= day).withColumn("_old", F.lit(True))
    s_cols = [c for c in target.columns if c not in SNAPSHOT_KEY]
    s = staged.select(*SNAPSHOT_KEY, *[F.col(c).alias(f"_n_{c}") for c in s_cols if c in staged.columns],
                      F.lit(True).alias("_new"))
    j = t.join(s, SNAPSHOT_KEY, "full_outer")
    changed = None
    for c in BASE360_COMPARE_NUM:
        d = X.differs_num(F.col(c), F.col(f"_n_{c}"))
        changed = d if changed is None else changed | d
    for c in BASE360_COMPARE_DATE:
        changed = changed | X.differs_date(F.col(c), F.col(f"_n_{c}"))
    is_new = F.col("_old").isNull()
    is_both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    is_upd = is_both & changed
    is_gone = F.col("_new").isNull() & F.col("id_retirada").isNull()
    out = []
    for c in target.columns:
        if c in SNAPSHOT_KEY:
            out.append(F.col(c))
        elif c == "id_retirada":
            out.append(F.when(is_new, F.lit(None).cast("int"))
                       .when(is_gone, F.lit(1)).otherwise(F.col(c)).alias(c))
        elif c in BASE360_SET:
            out.append(F.when(is_new | is_upd, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
    if mark:
        out.append(F.when(is_new, F.lit("I")).when(is_upd, F.lit("U"))
                   .when(is_gone, F.lit("R")).otherwise(F.lit("N")).alias("acao"))
    if source_flag:
        # row present in today's snapshot: the run's source row count
        out.append(F.col("_new").isNotNull().alias("na_origem"))
    return j.select(*out)


def today_snapshot(base360: DataFrame, as_of, cols=None) -> DataFrame:
    """Snapshot rows of ``as_of``'s day onwards (partition filter on
    ``data``)."""
    df = base360.filter(F.col("data") >= X.date_lit(as_of))
    return df.select(*cols) if cols else df


def run_base(spark, base_path: str, base: DataFrame) -> dict:
    """M1 as a job: full replace of ``Base`` (K2).  The new state does not
    read the table itself, so it is written straight over it; Spark's
    commit protocol makes the new files visible only at job end."""
    from arrears.sources import io
    io.replace(base, base_path, reads_target=False)
    n = spark.read.parquet(base_path).count()
    return {"linhas_origem": n, "linhas_inseridas": n}


def run_base360(spark, base360_path: str, base: DataFrame, as_of) -> DataFrame:
    """M2 as a job: derive today's snapshot from ``Base``, apply it to the
    stored Base360 (partitioned by ``data``; only ``data >= today`` is
    read, by partition pruning) and overwrite just those partitions from a
    staged copy.  Returns the volume counts (one row).  A first run on a
    missing table inserts everything."""
    from arrears.plans.runlog import volumes_from_actions
    from arrears.sources import io

    io.recover(spark, base360_path, ["data"], dynamic=True)
    staged = base360_derive(base, as_of)
    target = spark.read.parquet(base360_path) if io.exists(spark, base360_path) else staged.filter(F.lit(False))
    new = base360_apply(target.select(*staged.columns), staged, as_of, mark=True, source_flag=True)
    new = io.stage(new, base360_path)
    counts = volumes_from_actions(new, new.filter(F.col("na_origem"))).collect()
    io.publish(new, base360_path, ["data"], dynamic=True)
    return spark.createDataFrame(counts)
