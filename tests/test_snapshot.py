"""Open instalments, Base360 maintenance and the run job."""
import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from arrears.plans import snapshot

from conftest import rows

P = ("id_titulo long, numero_parcela int, id_situacao_parcela string, valor_principal decimal(19,4), "
     "data_vencimento timestamp_ntz, data_inclusao timestamp_ntz, data_reabertura timestamp_ntz")
AS_OF = dt.datetime(2026, 8, 17, 9, 30)


def T(s):
    return dt.datetime.fromisoformat(s)


def test_open_instalments_fixture(spark):
    p = spark.createDataFrame([
        (1, 2, "P", D(100), T("2026-07-10"), T("2026-01-01"), None),
        (1, 3, "A", D(100), T("2026-08-10"), T("2026-01-01"), None),
        (1, 4, "A", D(150), T("2026-08-17"), T("2026-01-02"), T("2026-08-01")),
    ], P)
    r = snapshot.open_instalments(p, AS_OF).first()
    assert (r.numero_parcela, r.risco, r.saldo_vencido) == (3, D("250.0000"), D("100.0000"))
    assert (r.data_vencimento, r.data_reabertura) == (T("2026-08-10"), T("2026-08-01"))
    only4 = snapshot.open_instalments(p.filter("numero_parcela = 4"), AS_OF).first()
    assert only4.saldo_vencido is None


def _base(spark, rows_):
    return spark.createDataFrame(rows_, "codigo_referencia int, carteira string, cluster string, id_devedor long, "
                                 "cnpj_cpf string, id_titulo long, numero_contrato string, razao_social_nome string, "
                                 "plano int, numero_parcela int, data_inclusao timestamp_ntz, "
                                 "data_vencimento timestamp_ntz, risco decimal(19,4), saldo_vencido decimal(19,4), "
                                 "valor_regularizacao decimal(19,4), area_negocio string")


def _row(k, risco, parcela=1):
    return (1, "C", "A1", 10 + k, "x", k, str(k), "n", 1, parcela, T("2026-01-01"), T("2026-05-01"),
            D(risco), None, None, "1")


def test_base360_apply(spark):
    morning = snapshot.base360_derive(_base(spark, [_row(1, 100), _row(2, 200), _row(3, 300)]), AS_OF)
    now = snapshot.base360_derive(_base(spark, [_row(1, 100), _row(2, 250), _row(4, 400)]), AS_OF)
    yesterday = snapshot.base360_derive(_base(spark, [_row(9, 900)]), AS_OF - dt.timedelta(days=1))
    target = morning.unionByName(yesterday)
    out = snapshot.base360_apply(target, now, AS_OF)
    got = {r.id_titulo: (r.acao, r.risco, r.id_retirada) for r in out.collect()}
    assert got == {1: ("N", D(100), None), 2: ("U", D(250), None), 3: ("R", D(300), 1), 4: ("I", D(400), None)}
    # derived columns go in at insert time
    r4 = out.filter("id_titulo = 4").first()
    assert r4.faixa_valor == "01. 0 a 500" and r4.dias_em_atraso == (AS_OF.date() - dt.date(2026, 5, 1)).days
    # second application is a no-op except the already flagged row
    again = snapshot.base360_apply(out.drop("acao"), now, AS_OF)
    assert again.filter("acao <> 'N'").count() == 0


def test_run_base360_writes_only_today(spark, scratch):
    path = f"{scratch}/base360"
    snapshot.run_base360(spark, path, _base(spark, [_row(1, 100)]), AS_OF - dt.timedelta(days=1))
    c = snapshot.run_base360(spark, path, _base(spark, [_row(1, 120), _row(2, 50)]), AS_OF).first()
    assert (c.linhas_inseridas, c.linhas_atualizadas) == (2, 0)
    c2 = snapshot.run_base360(spark, path, _base(spark, [_row(1, 130)]), AS_OF).first()
    assert (c2.linhas_inseridas, c2.linhas_atualizadas) == (0, 2)
    t = spark.read.parquet(path)
    assert rows(t, "data", "id_titulo", "risco", "id_retirada") == [
        (dt.date(2026, 8, 16), 1, D(100), None), (dt.date(2026, 8, 17), 1, D(130), None),
        (dt.date(2026, 8, 17), 2, D(50), 1)]
    assert t.select("id_base").distinct().count() == 3
    assert t.filter(F.col("data") >= F.lit("2026-08-17").cast("date")).count() == 2


def test_mart_append_is_idempotent(spark, scratch):
    from arrears.plans import marts
    path = f"{scratch}/crm"
    rows_ = [(1, dt.date(2026, 8, 17), T("2026-08-17 10:00"), "a"), (2, dt.date(2026, 8, 17), T("2026-08-17 10:00"), "b"),
             (2, dt.date(2026, 8, 17), T("2026-08-17 10:00"), "b")]
    staged = spark.createDataFrame(rows_, "id_base long, dia date, data timestamp_ntz, x string")
    scope = F.col("dia") >= F.lit("2026-08-17").cast("date")
    assert marts.append_new(spark, path, staged, ["id_base", "data"], "dia", scope) == 3   # D22: batch dups go in
    assert marts.append_new(spark, path, staged, ["id_base", "data"], "dia", scope) == 0
    assert spark.read.parquet(path).count() == 3


def test_today_slice_is_a_partition_filter(spark, scratch):
    path = f"{scratch}/b360"
    snapshot.run_base360(spark, path, _base(spark, [_row(1, 100)]), AS_OF - dt.timedelta(days=1))
    snapshot.run_base360(spark, path, _base(spark, [_row(1, 100)]), AS_OF)
    today = snapshot.today_snapshot(spark.read.parquet(path), AS_OF, ["id_base", "id_devedor"])
    plan = today._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data" in plan and "(data#" in plan
    assert today.count() == 1
