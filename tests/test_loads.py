"""A TableLoad end to end on files: run log, staged overwrite, volumes,
idempotence of a second run; and the streaming form of an insert-only load."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.plans import loads, runlog
from arrears.sources import io

SRC = T.StructType([T.StructField("id_titulo", T.LongType()), T.StructField("plano", T.IntegerType()),
                    T.StructField("data_atualizacao", T.TimestampNTZType())])
AS_OF = dt.datetime(2026, 8, 17, 9, 0)


def test_table_load_upsert_twice(spark, scratch):
    spec = loads.TableLoad("ProcT", "cob.T", "T", ["id_titulo"], loads.ID_OR_VERSION, loads.UPSERT,
                           id_col="id_titulo", version_col="data_atualizacao", set_cols=["plano", "data_atualizacao"])
    target = f"{scratch}/t"
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1)), (2, 1, dt.datetime(2026, 8, 1))], SRC) \
        .write.parquet(target)
    # a successful earlier run sets the watermark (backward form: 2026-08-15)
    rid, opened = runlog.start_run(spark, "ProcT", dt.datetime(2026, 8, 16, 8, 0))
    io.append(opened.unionByName(runlog.finish_run(spark, rid, "ProcT", dt.datetime(2026, 8, 16, 8, 0),
                                                   dt.datetime(2026, 8, 16, 8, 1))), logs["runs"])
    src = spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1)), (2, 5, dt.datetime(2026, 8, 16)),
                                 (3, 7, dt.datetime(2026, 8, 16))], SRC)
    runs = runlog.run_status(spark.read.parquet(logs["runs"]))
    c = spec.run(spark, src, target, runs, logs, AS_OF)
    assert (c["linhas_inseridas"], c["linhas_atualizadas"]) == (1, 1)
    assert c["linhas_origem"] == 2          # ids 2 (changed version) and 3 (new); id 1 is not extracted
    got = sorted((r.id_titulo, r.plano) for r in spark.read.parquet(target).collect())
    assert got == [(1, 1), (2, 5), (3, 7)]
    runs = runlog.run_status(spark.read.parquet(logs["runs"]))
    c2 = spec.run(spark, src, target, runs, logs, AS_OF + dt.timedelta(hours=1))
    assert (c2["linhas_inseridas"], c2["linhas_atualizadas"]) == (0, 0)
    assert spark.read.parquet(logs["volumes"]).count() == 2
    st = [r.status_execucao for r in runlog.run_status(spark.read.parquet(logs["runs"])).collect()]
    assert sorted(st) == ["Concluida"] * 3


def test_table_load_error_is_logged(spark, scratch):
    spec = loads.TableLoad("ProcT", "cob.T", "T", ["id_titulo"], loads.HIGH_WATER, id_col="id_titulo")
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    src = spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1))], SRC)
    try:
        spec.run(spark, src, f"{scratch}/missing", None, logs, AS_OF)
    except Exception:  # noqa: BLE001
        pass
    assert spark.read.parquet(logs["errors"]).first().etapa_erro == "Carga"
    assert [r.status_execucao for r in runlog.run_status(spark.read.parquet(logs["runs"])).collect()] == ["Erro"]


def test_25_load_specs():
    assert len(loads.LOADS) == 25 and len(loads.LOADS_BY_JOB) == 25


def test_streaming_insert_only(spark, scratch):
    from arrears.streaming.feed import insert_only_stream
    landing, target = f"{scratch}/landing", f"{scratch}/target"
    spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1)), (2, 1, dt.datetime(2026, 8, 1))], SRC) \
        .write.parquet(landing + "/b1")
    q = insert_only_stream(spark, landing + "/*", SRC, target, ["id_titulo"], "ins_test",
                           checkpoint=f"{scratch}/ckpt")
    q.processAllAvailable()
    spark.createDataFrame([(2, 1, dt.datetime(2026, 8, 1)), (3, 1, dt.datetime(2026, 8, 2))], SRC) \
        .write.parquet(landing + "/b2")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id_titulo for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _full(df, name):
    """``df`` with the other columns of a stored table, as NULLs."""
    from arrears.sources import schemas
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schemas.schema(name) if f.name not in df.columns})


def test_custom_specs_plan(spark):
    W = dt.date(2026, 8, 17)          # a Monday: payment date is Friday 08-14
    as_of = dt.datetime(2026, 8, 18, 9, 0)
    # L9 instalments: first load takes open or changed rows; next load only changed / new not held
    P = "id_parcela long, id_situacao_parcela string, data_inclusao timestamp_ntz, data_atualizacao timestamp_ntz"
    src = spark.createDataFrame([(1, "A", _ts("2026-01-01"), _ts("2026-01-02")),
                                 (2, "P", _ts("2026-01-01"), _ts("2026-08-17 10:00")),
                                 (3, "P", _ts("2026-01-01"), _ts("2026-01-02"))], P)
    src = _full(src, "parcelas")
    spec = loads.LOADS_BY_JOB["ProcParcelas"]
    first = spec.plan(src, src.limit(0), watermark=W)
    assert sorted(r.id_parcela for r in first.collect()) == [1, 2]
    held = src.filter("id_parcela in (1, 2)")
    nxt = spec.plan(src, held, watermark=W)
    assert {r.id_parcela: r.acao for r in nxt.collect()} == {1: "N", 2: "N"}
    # L10 info rows by parent state, NULL-safe version compare
    I_ = "id_parcela_informacao_complementar long, id_parcela long, data_reabertura date, data_atualizacao timestamp_ntz"
    info = spark.createDataFrame([(10, 1, dt.date(2026, 8, 1), None), (11, 2, None, None),
                                  (12, 3, dt.date(2026, 8, 1), None)], I_)
    info = _full(info, "parcelas_info")
    spec = loads.LOADS_BY_JOB["ProcParcelasInformacoesComplementares"]
    out = spec.plan(info, info.limit(0), watermark=W, inputs={"parcelas": src})
    assert sorted(r.id_parcela_informacao_complementar for r in out.collect()) == [10]
    # L11 agreements: dates since the watermark, or a child paid from the payment date on
    A = ("id_acordo long, id_status_acordo string, data_inclusao timestamp_ntz, data_cancelamento timestamp_ntz, "
         "data_aprovacao_proposta timestamp_ntz")
    acordos = spark.createDataFrame([(1, "O", _ts("2026-08-17 08:00"), None, None),
                                     (2, "O", _ts("2026-01-01"), None, None),
                                     (3, "O", _ts("2026-01-01"), None, None)], A)
    acordos = _full(acordos, "acordos")
    C = "id_acordo long, numero_parcela int, data_vencimento date, data_pagamento date"
    pagar = spark.createDataFrame([(2, 1, dt.date(2026, 9, 1), dt.date(2026, 8, 14)),
                                   (3, 1, dt.date(2026, 9, 1), dt.date(2026, 8, 13))], C)
    spec = loads.LOADS_BY_JOB["ProcAcordos"]
    out = spec.plan(acordos, acordos.limit(0), watermark=W, as_of=as_of, inputs={"parcelas_pagar": pagar})
    assert sorted((r.id_acordo, r.acao) for r in out.collect()) == [(1, "I"), (2, "I")]
    # L12 payable instalments: children of in-scope parents plus those paid exactly on the payment date
    spec = loads.LOADS_BY_JOB["ProcAcordosParcelasPagar"]
    assert spec.watermark_job == "ProcAcordos"
    st = spec.staged(pagar, pagar.limit(0), watermark=W, as_of=as_of, inputs={"acordos": acordos})
    assert sorted(r.id_acordo for r in st.collect()) == [2]
    # L13 negotiated instalments: union-all scope, then insert dedup by agreement
    N = "id_acordo_parcela_negociada long, id_acordo long, id_titulo long"
    neg = spark.createDataFrame([(100, 1, 7), (101, 1, 8), (102, 2, 9), (103, 3, 9)], N)
    spec = loads.LOADS_BY_JOB["AcordosParcelasNegociadas"]
    out = spec.plan(neg, neg.filter("id_acordo = 1").limit(1), watermark=W, as_of=as_of,
                    inputs={"acordos": acordos, "parcelas_pagar": pagar})
    assert sorted((r.id_acordo_parcela_negociada, r.acao) for r in out.collect()) == [(100, "N"), (102, "I")]


def test_recover_after_interrupted_overwrite(spark, scratch):
    import shutil
    path = f"{scratch}/tbl"
    io.replace(spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"), path, ["p"])
    assert io.recover(spark, path, ["p"]) is False   # healthy target: nothing to do
    io._publishing(spark, path, True)
    shutil.rmtree(f"{path}/p=2")                     # the job died between two partitions
    assert io.recover(spark, path, ["p"]) is True
    assert spark.read.parquet(path).count() == 2
    shutil.rmtree(path)                              # dropped on purpose: stays so
    assert io.recover(spark, path, ["p"]) is False and not io.exists(spark, path)


def test_remote_read_pushdown_and_purge(spark, scratch):
    from pyspark.sql import functions as F
    path = f"{scratch}/remote"
    spark.createDataFrame([(i, 1, dt.datetime(2026, 8, 1 + i % 20)) for i in range(100)], SRC).write.parquet(path)
    df = io.read_remote(spark, {"format": "parquet", "path": path},
                        where=F.col("data_atualizacao") >= F.lit("2026-08-15").cast("timestamp_ntz"),
                        columns=["id_titulo"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_atualizacao" in plan and "ReadSchema: struct<id_titulo:bigint" in plan
    assert df.count() == 30
    io.purge(spark, path, SRC)
    p = spark.read.parquet(path)
    assert p.count() == 0 and p.schema == SRC


def test_partitioned_insert_only_touches_only_new_ranges(spark, scratch):
    import os
    spec = loads.TableLoad("ProcEv", "oco.Ev", "Ev", ["id_titulo"], loads.HIGH_WATER, loads.INSERT_ONLY,
                           id_col="id_titulo", range_width=100)
    target = f"{scratch}/ev"
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    from arrears.sources import io as io_
    held = spark.createDataFrame([(i, 1, dt.datetime(2026, 8, 1)) for i in range(250)], SRC)
    held.withColumn("part", io_.key_range("id_titulo", 100)).write.partitionBy("part").parquet(target)
    before = {d: os.listdir(f"{target}/{d}") for d in os.listdir(target) if d.startswith("part=")}
    src = spark.createDataFrame([(i, 2, dt.datetime(2026, 8, 2)) for i in range(240, 320)], SRC)
    c = spec.run(spark, src, target, None, logs, AS_OF)
    assert c["linhas_inseridas"] == 70                       # ids 250..319
    t = spark.read.parquet(target)
    assert t.count() == 320 and t.select("id_titulo").distinct().count() == 320
    after = {d: os.listdir(f"{target}/{d}") for d in os.listdir(target) if d.startswith("part=")}
    assert after["part=0"] == before["part=0"] and after["part=1"] == before["part=1"]   # untouched ranges
    assert after["part=2"] != before["part=2"] and "part=3" in after


def test_char_columns_trimmed_on_read(spark, scratch):
    path = f"{scratch}/dev"
    spark.createDataFrame([(1, "123  ", "Ab "), (2, "123", "ab")], "id long, cpf string, nome string") \
        .write.parquet(path)
    df = io.read_source(spark, path, columns=["id", "cpf", "nome"], char_cols=["cpf", "nome"])
    assert df.filter("cpf = '123'").count() == 2          # trailing blanks ignored
    assert df.filter("nome = 'ab'").count() == 1          # still case-sensitive


def test_declared_schemas_parse_and_read(spark, scratch):
    from arrears.sources import schemas
    for name in schemas.DDL:
        assert len(schemas.schema(name).fields) > 1
    path = f"{scratch}/devedores"
    spark.createDataFrame([], schemas.schema("devedores")).write.parquet(path)
    df = schemas.read(spark, "devedores", path, columns=["id_devedor", "cnpj_cpf"])
    assert df.columns == ["id_devedor", "cnpj_cpf"] and df.count() == 0


def test_streaming_restart_from_checkpoint(spark, scratch):
    """A restarted stream resumes from its checkpoint: files already read are
    not re-read, and a batch replayed after a crash inserts nothing twice
    (insert-if-absent against the target)."""
    from arrears.streaming.feed import insert_only_stream
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/target", f"{scratch}/ckpt"
    spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1))], SRC).write.parquet(landing + "/b1")
    q = insert_only_stream(spark, landing + "/*", SRC, target, ["id_titulo"], "restart_a", checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1)), (2, 1, dt.datetime(2026, 8, 2))], SRC) \
        .write.parquet(landing + "/b2")
    q = insert_only_stream(spark, landing + "/*", SRC, target, ["id_titulo"], "restart_b", checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    ids = sorted(r.id_titulo for r in spark.read.parquet(target).collect())
    assert ids == [1, 2]


def test_read_table_by_catalog_name(spark):
    spark.createDataFrame([(1, 2, dt.datetime(2026, 8, 1))], SRC).createOrReplaceTempView("ods_titulos")
    df = io.read_table(spark, "ods_titulos", ["id_titulo"])
    assert df.columns == ["id_titulo"] and df.first().id_titulo == 1


def test_fill_once_and_unless_equal_specs(spark):
    """L8 (C1 + K3 + C6) and L12 (C1 + K3 + C5) through their specs."""
    P = "id long, data_atualizacao timestamp_ntz, pontuacao int"
    tgt = spark.createDataFrame([(1, None, 1), (2, dt.datetime(1900, 1, 1), 1), (3, dt.datetime(2026, 8, 1), 1),
                                 (4, dt.datetime(2026, 8, 1), 1)], P)
    src = spark.createDataFrame([(1, None, 9), (2, None, 9), (3, dt.datetime(2026, 8, 2), 9),
                                 (4, dt.datetime(2026, 8, 1), 9), (5, None, 9)], P)
    spec = loads.TableLoad("ProcTel", "cob.T", "T", ["id"], loads.FULL_ABSENT, loads.UPDATE_UNLESS_EQUAL,
                           version_col="data_atualizacao", set_cols=["data_atualizacao", "pontuacao"])
    got = {r.id: (r.pontuacao, r.acao) for r in spec.plan(src, tgt).collect()}
    assert got == {1: (1, "N"), 2: (1, "N"), 3: (9, "U"), 4: (1, "N"), 5: (9, "I")}
    Q = "id long, data_pagamento date, valor_pago int"
    tgt = spark.createDataFrame([(1, None, None), (2, dt.date(2026, 8, 1), 5), (3, None, None)], Q)
    src = spark.createDataFrame([(1, dt.date(2026, 8, 3), 7), (2, dt.date(2026, 8, 9), 8), (3, None, None),
                                 (4, dt.date(2026, 8, 3), 1)], Q)
    spec = loads.TableLoad("ProcPagar", "cob.P", "P", ["id"], loads.FULL_ABSENT, loads.FILL_ONCE,
                           version_col="data_pagamento", set_cols=["data_pagamento", "valor_pago"])
    got = {r.id: (r.data_pagamento, r.valor_pago, r.acao) for r in spec.plan(src, tgt).collect()}
    assert got == {1: (dt.date(2026, 8, 3), 7, "U"), 2: (dt.date(2026, 8, 1), 5, "N"), 3: (None, None, "N"),
                   4: (dt.date(2026, 8, 3), 1, "I")}


def test_touched_partitions_prunes(spark, scratch):
    from arrears.sources import io as io_
    path = f"{scratch}/parts"
    spark.range(1000).withColumn("part", io_.key_range("id", 100)).write.partitionBy("part").parquet(path)
    staged = spark.range(950, 1010).withColumn("part", io_.key_range("id", 100))
    df = io_.touched_partitions(spark.read.parquet(path), staged, "part")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part#" in plan and "IN (9,10)" in plan
    assert df.count() == 100


def test_insert_only_load_appends_without_rewrite(spark, scratch):
    import os
    spec = loads.TableLoad("ProcOrigens", "glo.Origens", "Origens", ["id_titulo"], loads.HIGH_WATER,
                           loads.INSERT_ONLY, id_col="id_titulo")
    target = f"{scratch}/orig"
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1))], SRC).write.parquet(target)
    before = set(f for f in os.listdir(target) if f.endswith(".parquet"))
    src = spark.createDataFrame([(1, 1, dt.datetime(2026, 8, 1)), (2, 1, dt.datetime(2026, 8, 2))], SRC)
    c = spec.run(spark, src, target, None, logs, AS_OF)
    after = set(f for f in os.listdir(target) if f.endswith(".parquet"))
    assert c["linhas_inseridas"] == 1 and before <= after          # old files untouched, new file added
    assert spec.run(spark, src, target, None, logs, AS_OF)["linhas_inseridas"] == 0
    assert sorted(r.id_titulo for r in spark.read.parquet(target).collect()) == [1, 2]
