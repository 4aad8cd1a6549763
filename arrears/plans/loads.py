"""The 25 table loads (L1-L25) as one parametric ``TableLoad`` spec.

Each load is *extract by watermark -> drop unchanged rows -> insert absent
keys -> update changed keys -> log volumes*.  The spec names the columns
and the extract shape; ``TableLoad.plan`` builds the new target state as
one lazy plan, ``TableLoad.run`` writes it and the logs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.operators import incremental as inc
from arrears.operators import merge as mg
from arrears.operators.joins import semi_by_ids
from arrears.plans import runlog
from arrears.sources import batches, io, ranges, schemas

# Extract shapes.
HIGH_WATER = "high_water"              # H1 / H2
ID_OR_VERSION = "id_or_version"        # H3 / H4
ID_OR_DATE = "id_or_date"              # H5 / F10
FULL_ABSENT = "full_absent"            # L25 (D4: anti join to the target)
CUSTOM = "custom"                      # H6-H10: an extract function

# Maintenance shapes.
INSERT_ONLY = "insert_only"
UPSERT = "upsert"
UPDATE_UNLESS_EQUAL = "update_unless_equal"
FILL_ONCE = "fill_once"


@dataclass(frozen=True)
class TableLoad:
    job: str
    source: str
    target: str
    key: Sequence[str]
    extract: str
    maintain: str = INSERT_ONLY
    id_col: str | None = None
    version_col: str | None = None
    date_col: str | None = None
    watermark_form: str = "backward"
    inclusive: bool = False
    set_cols: Sequence[str] = ()
    where: Callable[[], object] | None = None
    extract_fn: Callable[..., DataFrame] | None = None
    dedup_key: Sequence[str] | None = None
    notes: str = ""
    columns: Sequence[str] = field(default_factory=tuple)
    version_cols: Sequence[str] = ()      # several version columns (ProcAcordos)
    range_width: int | None = None        # partition the target by key range of this width
    target_schema: object = None          # StructType / DDL of the stored target (read even when empty)
    null_safe: bool = False               # C2: truly NULL-safe version compare
    watermark_job: str | None = None      # W3: the parent job whose log is read
    key_width: int | None = None          # keep the target as key ranges of this width (``sources.ranges``)
    absent_only: bool = False             # the extract has left out the rows whose key the target holds (J8)
    counts_extract: bool = False          # A10: the source rows are the extract's, not those left by C1 / J8

    @property
    def versions(self) -> list[str]:
        return list(self.version_cols) or ([self.version_col] if self.version_col else [])

    # -- plan --------------------------------------------------------------
    def staged(self, source: DataFrame, target: DataFrame, runs: DataFrame | None = None,
               as_of=None, watermark=None, inputs: dict | None = None) -> DataFrame:
        """The extract (rows that may need writing).  ``inputs`` holds the
        other source frames a custom extract reads (parents, children)."""
        if self.columns:
            source = source.select(*self.columns)
        if watermark is None and runs is not None and self.extract in (ID_OR_VERSION, ID_OR_DATE, CUSTOM):
            watermark = inc.watermark_of(runs, self.watermark_job or self.job, self.watermark_form)
        if self.extract == HIGH_WATER:
            return inc.extract_new(source, target, self.id_col, self.where() if self.where else None)
        if self.extract == ID_OR_VERSION:
            return inc.extract_new_or_changed(source, target, self.id_col, self.version_col, watermark,
                                              inclusive=self.inclusive)
        if self.extract == ID_OR_DATE:
            return inc.extract_id_or_date(source, target, self.id_col, self.date_col, watermark)
        if self.extract == FULL_ABSENT:
            return source.distinct()
        if self.extract == CUSTOM:
            return self.extract_fn(source, target, watermark=watermark, as_of=as_of, inputs=inputs or {})
        raise ValueError(self.extract)

    def counted(self, staged: DataFrame, target: DataFrame) -> DataFrame:
        """The rows a run counts as its source rows and goes on with (A10): the
        extract without the rows that the target holds in the same version
        (C1), or whose key it holds (J8, loads that only insert).  Loads with
        ``counts_extract`` count the extract itself: the contact and most
        dimension loads, which look the key up only when inserting, and L9 and
        L11, whose extract has dropped those rows."""
        if self.counts_extract or self.absent_only:
            return staged
        key = list(self.dedup_key or self.key)
        if self.maintain == INSERT_ONLY:
            return mg.insert_absent(target, staged, key)
        return mg.drop_unchanged(staged, target, key, self.versions)

    def volumes(self, source: DataFrame, target: DataFrame, watermark=None, as_of=None, inputs: dict | None = None) -> DataFrame:
        """The volume row (A10) of a run on these tables, as one lazy plan."""
        counted = self.counted(self.staged(source, target, None, as_of, watermark, inputs), target)
        return runlog.volumes_of(self.plan(source, target, None, as_of, watermark, inputs, staged=counted), counted)

    def plan(self, source: DataFrame, target: DataFrame, runs: DataFrame | None = None,
             as_of=None, watermark=None, inputs: dict | None = None,
             staged: DataFrame | None = None) -> DataFrame:
        """New target state, each row marked I / U / N (``acao``).  A
        precomputed extract can be passed as ``staged``."""
        if staged is None:
            staged = self.staged(source, target, runs, as_of, watermark, inputs)
        key = list(self.dedup_key or self.key)
        if self.maintain == INSERT_ONLY:
            new = staged.select(*target.columns)
            return mg.append(target, new, mark=True) if self.absent_only else mg.append_absent(target, new, key, mark=True)
        if self.maintain == UPSERT:
            return mg.upsert(target, staged.select(*target.columns), key, self.versions,
                             self.set_cols, mark=True, null_safe=self.null_safe)
        if self.maintain == UPDATE_UNLESS_EQUAL:
            # C1 then C6: the rows C1 keeps always differ by the sentinel
            # compare, which already implies "not equal and both non-NULL",
            # so the pair is the upsert rule -- one full outer join.
            return mg.upsert(target, staged.select(*target.columns), key, [self.version_col], self.set_cols,
                             mark=True)
        if self.maintain == FILL_ONCE:
            # C1 then K3 + C5 in the same single join
            return mg.upsert(target, staged.select(*target.columns), key, [self.version_col], self.set_cols,
                             mark=True, fill_only=True)
        raise ValueError(self.maintain)

    def _range_table(self, spark: SparkSession, path: str) -> ranges.RangeTable:
        schema = self.target_schema or schemas.schema(schemas.TABLES[self.target])
        return ranges.RangeTable(spark, path, list(self.key)[0], self.key_width, schema)

    def _run_ranges(self, spark, source, path, runs, as_of, inputs, run_id, set_stage) -> dict:
        """Update of a table kept as key ranges: the extract is staged, C1 looks
        only at the ranges it falls in, and only the ranges of the rows that are
        left are computed, written once and published."""
        table = self._range_table(spark, path)
        table.sweep()
        target = table.read()
        extract = io.stage(self.staged(source, target, runs, as_of, inputs=inputs).select(*table.schema.fieldNames()), path + "#extract")
        held = table.read(table.touched(extract))
        seen = Observation()
        counted = io.stage(self.counted(extract, held).observe(seen, F.count(F.lit(1)).alias("n")), path + "#counted")
        mg.require_unique(counted, list(self.dedup_key or self.key))
        touched = table.touched(counted)
        set_stage("Persistencia")
        new = self.plan(source, table.read(touched), runs, as_of, inputs=inputs, staged=counted)
        return table.rewrite(new, touched, run_id, int(seen.get["n"]))

    def unsettled(self, spark: SparkSession, path: str) -> dict[str, dict]:
        """Counts of runs that published their rows but may have died before
        logging them."""
        if self.key_width:
            last = self._range_table(spark, path).state()["last"]
            return {last["run"]: last["counts"]} if last else {}
        return batches.open_batches(spark, path)

    def settle(self, spark: SparkSession, path: str, log_paths: dict, as_of) -> None:
        """Log those runs (R2, R1): their volume row, unless it is there, and
        their end, unless they have one."""
        for run, counts in self.unsettled(spark, path).items():
            runlog.log_published(spark, run, self.job, self.source, self.target, counts, log_paths, as_of)
            if not self.key_width:
                batches.settle(spark, path, run)

    def _read_target(self, spark: SparkSession, path: str) -> DataFrame:
        """The stored target with its declared schema; a table that does not
        exist yet is an empty one (first run)."""
        if self.key_width:
            return self._range_table(spark, path).read()
        schema = self.target_schema
        if schema is None and self.target in schemas.TABLES and not io.exists(spark, path):
            schema = schemas.schema(schemas.TABLES[self.target])
            if self.range_width:
                schema = schema.add("part", "long")
        if not io.exists(spark, path) and schema is not None:
            return spark.createDataFrame([], schema)
        r = spark.read
        if self.target_schema is not None:
            r = r.schema(self.target_schema)
        return r.parquet(path)

    def _run_partitioned(self, spark, source, target_path, runs, as_of, inputs) -> DataFrame:
        """Range-partitioned target (``part`` = key range): the extract is
        computed against the whole target (high-water ids and versions),
        then only the partitions its rows fall in are read and rewritten.
        The key must be a single numeric column."""
        part = "part"
        key = list(self.dedup_key or self.key)[0]
        target = self._read_target(spark, target_path)
        staged = self.counted(self.staged(source, target.drop(part), runs, as_of, inputs=inputs), target.drop(part))
        staged = io.stage(staged.withColumn(part, io.key_range(key, self.range_width)), target_path + "#extract")

        def compute(t_slice, s):
            new = self.plan(s.drop(part), t_slice.drop(part), watermark=None, as_of=as_of, inputs=inputs,
                            staged=s.drop(part))
            return new.withColumn(part, io.key_range(key, self.range_width))

        return io.apply_to_partitions(spark, target_path, staged, part, compute, self.target_schema), staged

    # -- run ---------------------------------------------------------------
    def run(self, spark: SparkSession, source: DataFrame, target_path: str, runs: DataFrame,
            log_paths: dict, as_of, finished_at=None, inputs: dict | None = None) -> dict:
        """Log what an earlier run published and left unlogged, open the run,
        write the new target, log volumes and close the run; on failure log the
        error and close as ``Erro``.  The watermark moves only on ``Concluida``."""
        self.settle(spark, target_path, log_paths, as_of)

        def body(set_stage):
            if self.maintain == INSERT_ONLY:
                # Pure inserts: only the absent rows are written, once, and the
                # table is never rewritten.  With ``range_width`` the anti join
                # reads only the id ranges the extract falls in (a partition
                # filter).
                target = self._read_target(spark, target_path)
                part = "part" if self.range_width else None
                key = list(self.dedup_key or self.key)
                plain = target.drop(part) if part else target
                extract = self.staged(source, plain, runs, as_of, inputs=inputs)
                if part:
                    extract = extract.withColumn(part, io.key_range(key[0], self.range_width))
                seen = Observation()
                extract = io.stage(extract.observe(seen, F.count(F.lit(1)).alias("n")), target_path + "#extract")
                held = io.touched_partitions(target, extract, part) if part else target
                new = mg.insert_absent(held, extract.select(*target.columns), key)
                set_stage("Persistencia")
                batches.prepare(new, target_path, set_stage.run_id, int(seen.get["n"]) if self.counts_extract else None, [part] if part else None)
                return batches.finish(spark, target_path, set_stage.run_id)
            if self.key_width:
                return self._run_ranges(spark, source, target_path, runs, as_of, inputs, set_stage.run_id, set_stage)
            if self.range_width:
                set_stage("Persistencia")
                staged, extract = self._run_partitioned(spark, source, target_path, runs, as_of, inputs)
            else:
                io.recover(spark, target_path)
                target = self._read_target(spark, target_path)
                # The extract (incremental, small) is staged once without the
                # rows C1 drops: it is counted as the run's source rows and
                # planned from.
                extract = io.stage(self.counted(self.staged(source, target, runs, as_of, inputs=inputs), target),
                                   target_path + "#extract")
                mg.require_unique(extract, list(self.dedup_key or self.key))
                new = self.plan(source, target, runs, as_of, inputs=inputs, staged=extract)
                set_stage("Persistencia")
                # The marked new state is written once to the shared staging
                # folder: the counts and the overwrite both read that copy.
                staged = io.stage(new, target_path)
                io.publish(staged, target_path)
            return runlog.volumes_from_actions(staged, extract).first().asDict()

        counts = runlog.logged_run(spark, self.job, self.source, self.target, log_paths, as_of, body,
                                   finished_at)
        if not self.key_width:
            for run in batches.open_batches(spark, target_path):
                batches.settle(spark, target_path, run)
        return counts


# ---- custom extracts (H6-H10) ---------------------------------------------
AGREEMENT_DATES = ["data_inclusao", "data_cancelamento", "data_aprovacao_proposta"]


def _pay_date(watermark):
    from arrears.functions.derive import previous_business_day
    return previous_business_day(inc.as_watermark(watermark))


def extract_parcelas(source, target, watermark=None, as_of=None, inputs=None):
    """L9 (H9 + F11)."""
    return inc.extract_instalments(source, target, ["id_parcela"], "data_atualizacao", "data_inclusao",
                                   "id_situacao_parcela", "A", watermark)


def extract_parcelas_info(source, target, watermark=None, as_of=None, inputs=None):
    """L10 (H10 + J7, C2): needs ``inputs["parcelas"]``, the instalment source;
    without the rows that the target holds in the same version, NULL equal
    to NULL."""
    extract = inc.extract_by_parent_state(source, inputs["parcelas"], "id_parcela", "id_situacao_parcela", "A",
                                          "data_atualizacao", watermark, not_null_col="data_reabertura")
    return mg.drop_unchanged(extract, target, ["id_parcela_informacao_complementar"], ["data_atualizacao"], null_safe=True)


def extract_acordos(source, target, watermark=None, as_of=None, inputs=None):
    """L11 (H6 U H7, U3, J9): needs ``inputs["parcelas_pagar"]``."""
    b1 = mg.drop_unchanged(inc.extract_multi_date(source, AGREEMENT_DATES, watermark), target, ["id_acordo"],
                           ["id_status_acordo", "data_cancelamento", "data_aprovacao_proposta"])
    b2 = mg.drop_unchanged(
        inc.extract_by_child_dates(source, inputs["parcelas_pagar"], "id_acordo", "data_pagamento",
                                   "data_vencimento", watermark, _pay_date(watermark), as_of),
        target, ["id_acordo"], ["id_status_acordo"])
    return b1.unionByName(b2).distinct()


def extract_parcelas_pagar(source, target, watermark=None, as_of=None, inputs=None):
    """L12 (H8 + U2): needs ``inputs["acordos"]``, the agreement source."""
    scope = _scope(inputs, watermark, as_of).where(F.col("origem") == PARENT).select("id_acordo")
    return inc.extract_due_children(source, "id_acordo", scope, "data_pagamento", "data_vencimento",
                                    watermark, _pay_date(watermark), as_of)


def extract_agreement_children(source, target, watermark=None, as_of=None, inputs=None):
    """L13 / L14 (H8 + U1 + J6): needs ``inputs["acordos"]`` and
    ``inputs["parcelas_pagar"]``, or the scope made of them.  Both loads leave
    out the agreements that the target holds (J8): these go from the key list
    already, and the children, wide rows, are not shuffled to be compared
    (``absent_only``: an anti join after it Spark would move below it)."""
    scope = inc.key_set(_scope(inputs, watermark, as_of), "id_acordo")
    return semi_by_ids(source, mg.insert_absent(target, scope, ["id_acordo"]), "id_acordo")


PARENT, CHILD = "A", "P"


def agreement_scope(acordos, parcelas_pagar, watermark, as_of) -> DataFrame:
    """The agreements that L12-L14 look at: ``id_acordo`` and ``origem``, their
    own dates (``A``) or those of their instalments (``P``).  A day makes it
    once for all three (``plans.day``)."""
    from arrears.functions.derive import date_lit
    w = inc.as_watermark(watermark)
    by_parent = inc.parents_in_scope(acordos, "id_acordo", AGREEMENT_DATES, watermark)
    by_child = parcelas_pagar.filter((F.to_date("data_pagamento") == _pay_date(watermark))
                                     | F.to_date("data_vencimento").between(w, date_lit(as_of))).select("id_acordo")
    return by_parent.withColumn("origem", F.lit(PARENT)).unionByName(by_child.withColumn("origem", F.lit(CHILD)))


def _scope(inputs, watermark, as_of) -> DataFrame:
    if "escopo" in inputs:
        return inputs["escopo"]
    if "parcelas_pagar" in inputs:
        return agreement_scope(inputs["acordos"], inputs["parcelas_pagar"], watermark, as_of)
    return inc.parents_in_scope(inputs["acordos"], "id_acordo", AGREEMENT_DATES, watermark).withColumn("origem", F.lit(PARENT))


# Contact tables grow by increasing ids: partition them by ranges of this
# many ids, so a load rewrites only the newest ranges.
CONTACT_RANGE = 10_000_000

# Rows of the updated tables are kept in ranges of this many ids: an update
# rewrites the ranges it falls in, some hundred MB each.
KEY_RANGE = 5_000_000

# The 25 loads.  Column lists beyond the key / version / set columns are
# the tables' own (declared in their schemas), so they are not repeated.
LOADS: list[TableLoad] = [
    TableLoad("ProcTitulos", "cob.Titulos", "Titulos", ["id_titulo"], ID_OR_VERSION, UPSERT,
              id_col="id_titulo", version_col="data_atualizacao",
              set_cols=["id_carteira", "plano", "percentual_juros_remuneratorios", "data_atualizacao",
                        "id_usuario_atualizacao", "data_exclusao", "id_usuario_exclusao"], key_width=KEY_RANGE),
    TableLoad("ProcDevedores", "cob.Devedores", "Devedores", ["id_devedor"], ID_OR_VERSION, UPSERT,
              id_col="id_devedor", version_col="data_atualizacao", inclusive=True,
              set_cols=["data_atualizacao", "id_usuario_atualizacao", "data_exclusao", "id_usuario_exclusao",
                        "id_ultimo_enriquecimento", "apelido"], key_width=KEY_RANGE),
    TableLoad("ProcDevedoresInformacoesComplementares", "cli.DevedoresInformacoesComplementares",
              "DevedoresInformacoesComplementares", ["id_devedor_informacao_complementar"],
              ID_OR_VERSION, UPSERT, id_col="id_devedor_informacao_complementar",
              version_col="data_atualizacao", set_cols=["*"], key_width=KEY_RANGE, notes="9 set columns"),
    TableLoad("ProcTitulosInformacoesComplementares", "cli.TitulosInformacoesComplementares",
              "TitulosInformacoesComplementares", ["id_titulo_informacao_complementar"],
              ID_OR_VERSION, UPSERT, id_col="id_titulo_informacao_complementar",
              version_col="data_atualizacao", set_cols=["*"], key_width=KEY_RANGE, notes="all 88 non-key columns"),
    TableLoad("ProcUsuarios", "glo.Usuarios", "Usuarios", ["id_usuario"], ID_OR_VERSION, UPSERT,
              id_col="id_usuario", version_col="data_atualizacao", inclusive=True,
              set_cols=["nome", "referencia", "data_admissao", "data_demissao", "data_atualizacao"], key_width=KEY_RANGE),
    TableLoad("ProcEscob", "cli.Escob", "Escob", ["id_escob"], ID_OR_VERSION, UPSERT,
              id_col="id_escob", version_col="data_atualizacao", set_cols=["cluster", "data_atualizacao"], key_width=KEY_RANGE),
    TableLoad("ProcPropensao", "cli.Propensao", "Propensao", ["id_propensao"], ID_OR_VERSION, UPSERT,
              id_col="id_propensao", version_col="data_atualizacao",
              set_cols=["cluster", "data_atualizacao"], key_width=KEY_RANGE),
    TableLoad("ProcTelefones", "cob.Telefones", "Telefones", ["id_telefone"], ID_OR_VERSION,
              UPDATE_UNLESS_EQUAL, id_col="id_telefone", version_col="data_atualizacao", inclusive=True,
              set_cols=["data_atualizacao", "pontuacao"], key_width=KEY_RANGE),
    TableLoad("ProcParcelas", "cob.Parcelas", "Parcelas", ["id_parcela"], CUSTOM, UPSERT,
              id_col="id_parcela", version_col="data_atualizacao", watermark_form="forward",
              set_cols=["id_origem", "tipo", "id_situacao_parcela", "data_previsao_devolucao", "data_devolucao",
                        "id_motivo_devolucao", "data_atualizacao", "id_usuario_atualizacao", "data_exclusao",
                        "id_usuario_exclusao", "valido_de", "valido_ate"], extract_fn=extract_parcelas,
              counts_extract=True, key_width=KEY_RANGE, notes="H9"),
    TableLoad("ProcParcelasInformacoesComplementares", "cli.ParcelasInformacoesComplementares",
              "ParcelasInformacoesComplementares", ["id_parcela_informacao_complementar"], CUSTOM,
              UPSERT, version_col="data_atualizacao", watermark_form="forward",
              set_cols=["data_atualizacao", "id_usuario_atualizacao", "data_reabertura", "valido_de", "valido_ate"],
              extract_fn=extract_parcelas_info, counts_extract=True, key_width=KEY_RANGE,
              notes="H10; C2 in the extract, C1 in the update"),
    TableLoad("ProcAcordos", "cob.Acordos", "Acordos", ["id_acordo"], CUSTOM, UPSERT,
              version_cols=["id_status_acordo", "data_cancelamento", "data_aprovacao_proposta"],
              watermark_form="forward", extract_fn=extract_acordos,
              set_cols=["data_aprovacao_proposta", "id_status_acordo", "codigo_acordo_cliente",
                        "data_cancelamento", "id_usuario_cancelamento"], counts_extract=True, key_width=KEY_RANGE, notes="H6 U H7"),
    TableLoad("ProcAcordosParcelasPagar", "cob.AcordosParcelasPagar", "AcordosParcelasPagar",
              ["id_acordo_parcela_pagar"], CUSTOM, FILL_ONCE, version_col="data_pagamento",
              watermark_form="penultimate", watermark_job="ProcAcordos", extract_fn=extract_parcelas_pagar,
              set_cols=["data_pagamento", "valor_pago"], key_width=KEY_RANGE, notes="H8 + U2"),
    TableLoad("AcordosParcelasNegociadas", "cob.AcordosParcelasNegociadas", "AcordosParcelasNegociadas",
              ["id_acordo_parcela_negociada"], CUSTOM, INSERT_ONLY, watermark_form="penultimate",
              watermark_job="ProcAcordos", extract_fn=extract_agreement_children,
              dedup_key=["id_acordo"], absent_only=True, notes="H8 + U1; D21 dedup by agreement"),
    TableLoad("AcordosInformacoesComplementares", "cli.AcordosInformacoesComplementares",
              "AcordosInformacoesComplementares", ["id_acordo"], CUSTOM, INSERT_ONLY,
              watermark_form="penultimate", watermark_job="ProcAcordos",
              extract_fn=extract_agreement_children, absent_only=True, notes="H8 + U1"),
    TableLoad("ProcEventos", "oco.Eventos", "Eventos", ["id_evento"], ID_OR_DATE, INSERT_ONLY,
              id_col="id_evento", date_col="data_evento", watermark_form="forward", range_width=CONTACT_RANGE, counts_extract=True),
    TableLoad("ProcOcorrencias", "oco.Ocorrencias", "Ocorrencias", ["id_ocorrencia"], ID_OR_DATE,
              INSERT_ONLY, id_col="id_ocorrencia", date_col="data_ocorrencia", watermark_form="forward",
              range_width=CONTACT_RANGE, counts_extract=True),
    TableLoad("ProcLigacoes", "lig.Ligacoes", "Ligacoes", ["id_ligacao"], ID_OR_DATE, INSERT_ONLY,
              id_col="id_ligacao", date_col="data_inicializacao", watermark_form="forward",
              range_width=CONTACT_RANGE, counts_extract=True),
    TableLoad("Carteiras", "glo.Carteiras", "Carteiras", ["id_carteira"], HIGH_WATER, INSERT_ONLY,
              counts_extract=True, id_col="id_carteira", where=lambda: F.col("id_cliente") == F.lit(5)),
    TableLoad("ProcOrigens", "glo.Origens", "Origens", ["id_origem"], HIGH_WATER, INSERT_ONLY,
              counts_extract=True, id_col="id_origem"),
    TableLoad("ProcProdutos", "glo.Produtos", "Produtos", ["id_produto"], HIGH_WATER, INSERT_ONLY,
              counts_extract=True, id_col="id_produto"),
    TableLoad("ProcStatusAcordos", "cob.StatusAcordos", "StatusAcordos", ["id_status_acordo"],
              HIGH_WATER, INSERT_ONLY, counts_extract=True, id_col="id_status_acordo"),
    TableLoad("ProcTiposAcordos", "cob.TiposAcordos", "TiposAcordos", ["id_tipo_acordo"], HIGH_WATER,
              INSERT_ONLY, counts_extract=True, id_col="id_tipo_acordo"),
    TableLoad("ProcTiposEventos", "glo.TiposEventos", "TiposEventos", ["id_tipo_evento"], HIGH_WATER,
              INSERT_ONLY, counts_extract=True, id_col="id_tipo_evento"),
    TableLoad("ProcTiposOcorrencias", "glo.TiposOcorrencias", "TiposOcorrencias", ["id_tipo_ocorrencia"],
              HIGH_WATER, INSERT_ONLY, counts_extract=True, id_col="id_tipo_ocorrencia"),
    TableLoad("ProcOrigensLigacoes", "lig.OrigensLigacoes", "OrigensLigacoes", ["id_origem_ligacao"],
              FULL_ABSENT, INSERT_ONLY, notes="D4: anti join to the target"),
]

LOADS_BY_JOB = {spec.job: spec for spec in LOADS}
