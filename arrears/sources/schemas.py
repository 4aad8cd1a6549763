"""Declared schemas of the warehouse tables (Spark DDL), for
``read_source(schema=...)`` and for creating empty tables.

Types follow the source DDL: ``int`` -> int, ``smallint`` / ``tinyint`` ->
smallint, ``bigint`` -> bigint, ``money`` -> decimal(19,4), ``float`` ->
double, ``datetime`` family -> timestamp_ntz (wall-clock), ``date`` ->
date, text -> string.
"""

from __future__ import annotations

from pyspark.sql import types as T

DDL = {
    # The columns of the stored tables, in their order.
    "titulos": "id_titulo int, id_empresa smallint, id_devedor int, id_carteira smallint, id_produto "
        "smallint, id_origem smallint, numero_contrato string, plano smallint, "
        "percentual_juros_remuneratorios double, data_inclusao timestamp_ntz, id_usuario_inclusao "
        "int, data_atualizacao timestamp_ntz, id_usuario_atualizacao int, data_exclusao "
        "timestamp_ntz, id_usuario_exclusao int, valido_de timestamp_ntz, valido_ate timestamp_ntz",
    "titulos_info": "id_titulo_informacao_complementar int, data_inclusao timestamp_ntz, id_usuario_inclusao int, "
        "data_atualizacao timestamp_ntz, id_usuario_atualizacao int, id_titulo int, tipo_contrato "
        "string, agencia_plataforma string, regiao_plataforma string, numero_recebimento string, "
        "data_contratacao timestamp_ntz, data_vencimento_contrato_fatura timestamp_ntz, "
        "valor_contrato_atualizado decimal(19,4), quantidade_parcela_atraso smallint, "
        "valor_contrato_vencimento decimal(19,4), empresa string, data_envio_contrato timestamp_ntz, "
        "data_limite_retorno_contrato timestamp_ntz, codigo_parecer_escritorio_anterior string, "
        "parecer_escritorio_anterior1 string, parecer_escritorio_anterior2 string, codigo_filial "
        "string, valor_encargos_contrato decimal(19,4), codigo_estrategia string, tarifa_cobranca "
        "decimal(19,4), fase_cobranca string, codigo_segurador string, codigo_operacao_finaustria "
        "string, numero_contrato_finaustria string, credito_imobiliario_suslim string, "
        "estrategia_idstg1 string, data_ativacao_cobranca_consorcio timestamp_ntz, numero_cartao "
        "string, agencia_conta_cedente_dac string, codigo_carteira string, valor_acordo_pl "
        "decimal(19,4), codigo_ocorrencia_cobranca_juridico string, categoria_veiculo_cliente string, "
        "numero_parcela string, id_titulo_original int, contrato_piloto string, data_exclusao "
        "timestamp_ntz, id_usuario_exclusao int, valido_de timestamp_ntz, valido_ate timestamp_ntz, "
        "valor_entrada_diferenciada decimal(19,4), data_entrega_amigavel date, data_ultimo_atraso "
        "timestamp_ntz, data_vencimento_proxima_parcela timestamp_ntz, codigo_familia_produto string, "
        "quantidade_parcelas_aberto_contrato string, quantidade_parcelas_pagas string, "
        "data_ultimo_envio_email timestamp_ntz, data_ultimo_envio_push timestamp_ntz, "
        "data_ultimo_envio_sms timestamp_ntz, valor_minimo_fatura string, valor_saldo_total_fatura "
        "string, quantidade_dias_utiliza_lis string, valor_saldo_total_fatura_sistema string, "
        "quant_parcelamentos_fatura string, valor_referencia_fatura string, "
        "valor_minimo_fatura_sistema string, data_ultimo_pagamento_fatura timestamp_ntz, "
        "codigo_escritorio_cobranca string, nome_produto string, area_negocio string, "
        "quantidade_dias_atraso string, codigo_subnivel_carteira string, codigo_cluster_score string, "
        "codigo_motivo_exclusao string, origem string, correlation_id string, "
        "valor_total_risco_vencido string, quantidade_total_parcelas string, "
        "valor_contrato_no_vencimento string, taxa_juros_nominal string, codigo_renavam string, "
        "indicador_saldo_remanescente string, data_venda_veiculo string, data_apreensao_veiculo "
        "string, indicador_acao_contra string, codigo_placa_veiculo string, ano_modelo_veiculo "
        "string, ano_fabricacao_veiculo string, modelo_marca_veiculo string, data_vencimento_contrato "
        "string, data_ultima_parcela_consig string, valor_ultimo_pagamento_consignado string, "
        "valor_saldo_devedor_contabil string",
    "devedores": "id_devedor int, id_origem smallint, cnpj_cpf string, rg string, razao_social_nome string, "
        "data_inclusao timestamp_ntz, id_usuario_inclusao int, data_atualizacao timestamp_ntz, "
        "id_usuario_atualizacao int, data_exclusao timestamp_ntz, id_usuario_exclusao int, "
        "id_ultimo_enriquecimento int, apelido string, valido_de timestamp_ntz, valido_ate "
        "timestamp_ntz",
    "devedores_info": "id_devedor_informacao_complementar int, data_inclusao timestamp_ntz, id_usuario_inclusao "
        "int, data_atualizacao timestamp_ntz, id_usuario_atualizacao int, id_devedor int, "
        "data_nascimento timestamp_ntz, sexo_cliente string, valido_de timestamp_ntz, valido_ate "
        "timestamp_ntz",
    "telefones": "id_telefone int, id_devedor int, id_origem int, id_qualificacao int, id_propriedade int, ddd "
        "string, numero string, pontuacao decimal(18,0), data_inclusao timestamp_ntz, "
        "data_atualizacao timestamp_ntz",
    "parcelas": "id_parcela int, id_titulo int, id_origem smallint, numero_parcela smallint, tipo string, "
        "id_situacao_parcela string, valor_principal decimal(19,4), data_vencimento timestamp_ntz, "
        "data_previsao_devolucao timestamp_ntz, data_devolucao timestamp_ntz, id_motivo_devolucao "
        "string, data_inclusao timestamp_ntz, id_usuario_inclusao int, data_atualizacao "
        "timestamp_ntz, id_usuario_atualizacao int, data_exclusao timestamp_ntz, id_usuario_exclusao "
        "int, valido_de timestamp_ntz, valido_ate timestamp_ntz",
    "parcelas_info": "id_parcela_informacao_complementar int, data_inclusao timestamp_ntz, id_usuario_inclusao "
        "int, data_atualizacao timestamp_ntz, id_usuario_atualizacao int, id_parcela int, "
        "data_reabertura date, valido_de timestamp_ntz, valido_ate timestamp_ntz",
    "carteiras": "id_carteira smallint, id_cliente smallint, codigo_referencia smallint, carteira string, "
        "razao_social string",
    "produtos": "id_produto smallint, produto string, codigo_referencia string",
    "origens": "id_origem int, origem string",
    "origens_ligacoes": "id_origem_ligacao string, origem_ligacao string, codigo_referencia string",
    "status_acordos": "id_status_acordo int, status_acordo string",
    "tipos_acordos": "id_tipo_acordo smallint, tipo_acordo string",
    "escob": "id_escob int, id_devedor int, id_titulo int, cluster string, data_atualizacao timestamp_ntz",
    "propensao": "id_propensao int, id_titulo int, cluster string, data_atualizacao timestamp_ntz",
    "acordos": "id_acordo int, id_tipo_acordo smallint, id_devedor int, plano smallint, "
        "id_negociador_responsavel int, data_inclusao timestamp_ntz, id_usuario_inclusao int, "
        "proposta string, data_aprovacao_proposta timestamp_ntz, id_status_acordo smallint, "
        "codigo_acordo_cliente string, data_cancelamento timestamp_ntz, id_usuario_cancelamento int",
    "acordos_info": "id_acordo int, data_envio_proposta timestamp_ntz, valor_contra_proposta decimal(19,4), "
        "plano_contra_proposta smallint, data_vencimento_contra_proposta date, data_retorno "
        "timestamp_ntz, id_campanha_codigo_barra bigint, id_boleto int, id_jornada string, "
        "id_simulacao string, id_condicao_geral string, id_resumo string, codigo_alcada smallint, "
        "codigo_banco string, numero_agencia string, numero_conta string",
    "acordos_parcelas_negociadas": "id_acordo_parcela_negociada int, id_acordo int, id_titulo int, id_parcela int, faixa_atraso "
        "smallint, valor_principal_atualizado decimal(19,4), valor_principal_campanha decimal(19,4), "
        "valor_cobrado decimal(19,4), valor_juros_moratorios_atualizado decimal(19,4), "
        "valor_juros_moratorios_campanha decimal(19,4), valor_juros_moratorios_cobrado decimal(19,4), "
        "valor_juros_remuneratorios_atualizado decimal(19,4), valor_juros_remuneratorios_campanha "
        "decimal(19,4), valor_juros_remuneratorios_cobrado decimal(19,4), valor_multa_atualizado "
        "decimal(19,4), valor_multa_campanha decimal(19,4), valor_multa_cobrado decimal(19,4), "
        "valor_honorarios_atualizado decimal(19,4), valor_honorarios_campanha decimal(19,4), "
        "valor_honorarios_cobrado decimal(19,4), valor_despesa_cobrado decimal(19,4), "
        "valor_desconto_cliente decimal(19,4), percentual_principal_campanha double, "
        "percentual_principal_cobrado double, percentual_multa_padrao double, "
        "percentual_multa_campanha double, percentual_multa_cobrado double, "
        "percentual_juros_remuneratorios_padrao double, percentual_juros_remuneratorios_campanha "
        "double, percentual_juros_remuneratorios_cobrado double, percentual_honorarios_padrao double, "
        "percentual_honorarios_campanha double, percentual_honorarios_cobrado double, "
        "percentual_juros_moratorios_padrao double, percentual_juros_moratorios_campanha double, "
        "percentual_juros_moratorios_cobrado double, numero_parcela smallint, "
        "valor_comissao_assessoria decimal(19,4), descricao_parcelas string, "
        "percentual_desconto_autorizado double",
    "acordos_parcelas_pagar": "id_acordo_parcela_pagar int, id_acordo int, numero_parcela smallint, data_vencimento date, "
        "valor decimal(19,4), data_pagamento date, valor_pago decimal(19,4)",
    "ocorrencias": "id_ocorrencia int, id_devedor int, id_titulo int, id_parcela int, id_tipo_ocorrencia int, "
        "id_origem int, id_ligacao int, data_ocorrencia timestamp_ntz, data_complementar "
        "timestamp_ntz, complemento string, data_inclusao timestamp_ntz, id_usuario_inclusao int, "
        "data_atualizacao timestamp_ntz, id_usuario_atualizacao int, id_acordo int",
    "eventos": "id_evento int, id_devedor int, id_titulo int, id_parcela int, id_tipo_evento smallint, "
        "id_origem smallint, id_ligacao int, data_evento timestamp_ntz, data_complementar "
        "timestamp_ntz, complemento string, data_inclusao timestamp_ntz, id_usuario_inclusao int, "
        "data_atualizacao timestamp_ntz, id_usuario_atualizacao int",
    "tipos_ocorrencias": "id_tipo_ocorrencia smallint, id_tipo_ocorrencia_referencia smallint, id_segmentacao string, "
        "codigo_ocorrencia string, tipo_ocorrencia string, agendamento string, data_complementar "
        "string, exige_complemento string, sistema string, id_classificacao smallint",
    "tipos_eventos": "id_tipo_evento smallint, id_tipo_evento_referencia smallint, id_segmentacao string, "
        "codigo_evento string, tipo_evento string, agendamento string, data_complementar string, "
        "exige_complemento string, sistema string, id_classificacao smallint",
    "ligacoes": "id_ligacao int, chave string, id_discador smallint, id_origem_ligacao string, "
        "id_telefone_ligacao int, uf_ligacao string, ddd_ligacao string, numero_ligacao string, "
        "data_finalizacao timestamp_ntz, id_telefone_agendamento int, uf_agendamento string, "
        "ddd_agendamento string, numero_agendamento string, data_agendamento timestamp_ntz, "
        "agendamento_fidelizado string, data_inicializacao timestamp_ntz, id_usuario_allure int, "
        "id_usuario_discador int, id_devedor int",
    "usuarios": "id_usuario int, nome string, referencia string, data_admissao timestamp_ntz, data_demissao "
        "timestamp_ntz, data_atualizacao timestamp_ntz",
    "base": "codigo_referencia smallint, carteira string, produto string, cluster string, id_devedor int, "
        "cnpj_cpf string, id_titulo int, numero_contrato string, razao_social_nome string, plano "
        "smallint, numero_parcela smallint, data_inclusao timestamp_ntz, data_vencimento "
        "timestamp_ntz, risco decimal(19,4), saldo_vencido decimal(19,4), valor_regularizacao "
        "decimal(19,4), area_negocio string",
    "crm360": "id_crm int, id_base int, data timestamp_ntz, id_devedor int, id_titulo int, "
        "codigo_ocorrencia string, tipo_ocorrencia string, id_ligacao int, id_origem_ligacao string, "
        "ddd string, numero string, chave string, id_acordo int, referencia string, atendimento int, "
        "cpc int, acordo int",
    "discador360": "id_discador int, id_base int, data timestamp_ntz, id_devedor int, id_titulo int, ddd string, "
        "numero string, origem string, classificacao string, motivo_finalizacao string, referencia "
        "string, campanha string, tipo_telefone string, duracao_chamada double, duracao_falado "
        "double, duracao_tabulando double, chave string",
    "discador_digital360": "id_discador_digital int, id_base int, data timestamp_ntz, codigo_referencia smallint, "
        "id_devedor int, id_titulo int, ddd string, numero string, origem string, classificacao "
        "string, motivo_finalizacao string, referencia string, campanha string, duracao_chamada int, "
        "chave string",
    "pagamentos360": "id_pagamento int, data timestamp_ntz, id_acordo int, tipo_acordo string, id_devedor int, "
        "id_titulo int, plano int, numero_parcela int, valor_pago decimal(19,4), referencia string, "
        "proposta string, data_aprovacao_proposta timestamp_ntz, status_acordo string, "
        "id_origem_acordo string",
    "vencimentos360": "id_vencimento int, id_base int, data timestamp_ntz, id_acordo int, tipo_acordo string, "
        "id_devedor int, id_titulo int, plano int, numero_parcela int, valor decimal(19,4), "
        "referencia string, proposta string, data_aprovacao_proposta timestamp_ntz, status_acordo "
        "string, data_cancelamento timestamp_ntz, id_origem_acordo string",
    "mailing_source": "id_devedor int, id_carteira int",
    "mailing": "id_devedor int, id_carteira int, id_retirada int",
    "origem_acordos": "id_acordo int, id_origem_acordo string",
    # remote dialer extracts
    "dialer_calls": "inicio_discagem timestamp_ntz, cliente int, codigo_referencia smallint, cpf_cnpj string, "
                    "contrato string, telefone_discado string, origem string, classificacao string, "
                    "motivo_finalizacao string, cobrador string, campanha string, tipo_telefone string, "
                    "duracao_chamada int, duracao_conectado int, duracao_wrap_up int, itr_key string",
    "digital_calls": "data timestamp_ntz, cliente int, codigo_referencia smallint, cpf_cnpj string, "
                     "contrato string, telefone_discado string, origem string, classificacao string, "
                     "tabulacao string, cobrador string, campanha string, duracao_chamada int, call_id string",
    # DW marts
    "base360": "id_base bigint, data date, codigo_referencia smallint, carteira string, produto string, "
               "sub_produto string, cluster string, id_devedor int, cnpj_cpf string, id_titulo int, "
               "numero_contrato string, razao_social_nome string, plano smallint, numero_parcela smallint, "
               "data_inclusao timestamp_ntz, data_vencimento timestamp_ntz, dias_em_atraso int, "
               "faixa_atraso string, risco decimal(19,4), saldo_vencido decimal(19,4), "
               "valor_regularizacao decimal(19,4), faixa_valor string, id_retirada int",
    "base_mailing360": "id_base bigint, data date, id_devedor int, id_titulo int, id_retirada int",
    # control
    "purge_config": "id_tabela_expurgo int, nome_tabela string, hora_expurgo string",
    "purge_done": "id_tabela_expurgo int, nome_tabela string, data_execucao timestamp_ntz",
}

# Fixed-width text columns (``char(n)``), trimmed on read.
CHAR_COLUMNS = {
    "devedores": ["cnpj_cpf", "rg"],
}

#: How the server compares text: without regard to case and trailing blanks.
SERVER_TEXT = "UTF8_LCASE_RTRIM"
#: Text columns that jobs compare: keys, states and codes.
COMPARED = {
    "devedores": ["cnpj_cpf"], "dialer_calls": ["cpf_cnpj"], "digital_calls": ["cpf_cnpj"], "parcelas": ["id_situacao_parcela"],
    "titulos_info": ["codigo_cluster_score", "area_negocio"], "escob": ["cluster"], "propensao": ["cluster"],
    "ligacoes": ["id_origem_ligacao"], "origens_ligacoes": ["id_origem_ligacao"],
}


def as_server_text(df, name: str):
    """The compared text columns of a table with the server's collation, so
    that joins, lists, groups and anti joins on them ignore case and trailing
    blanks as there.  Such a compare is not pushed to a Parquet scan as a plain
    one would be (its row groups are ordered by bytes): use it where the text
    needs it."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.collate(F.col(c), SERVER_TEXT) for c in COMPARED.get(name, []) if c in df.columns})


def as_plain_text(df):
    """Collated columns as plain strings, for output."""
    from pyspark.sql import functions as F
    return df.withColumns({f.name: F.collate(F.col(f.name), "UTF8_BINARY") for f in df.schema if isinstance(f.dataType, T.StringType)})


def schema(name: str) -> T.StructType:
    """The declared ``StructType`` of a warehouse table."""
    return T.StructType.fromDDL(DDL[name])


#: The schema name of each load's target table.
TABLES = {
    "Titulos": "titulos", "Devedores": "devedores", "DevedoresInformacoesComplementares": "devedores_info",
    "TitulosInformacoesComplementares": "titulos_info", "Usuarios": "usuarios", "Escob": "escob", "Propensao": "propensao",
    "Telefones": "telefones", "Parcelas": "parcelas", "ParcelasInformacoesComplementares": "parcelas_info", "Acordos": "acordos",
    "AcordosParcelasPagar": "acordos_parcelas_pagar", "AcordosParcelasNegociadas": "acordos_parcelas_negociadas",
    "AcordosInformacoesComplementares": "acordos_info", "Eventos": "eventos", "Ocorrencias": "ocorrencias", "Ligacoes": "ligacoes",
    "Carteiras": "carteiras", "Origens": "origens", "Produtos": "produtos", "StatusAcordos": "status_acordos",
    "TiposAcordos": "tipos_acordos", "TiposEventos": "tipos_eventos", "TiposOcorrencias": "tipos_ocorrencias", "OrigensLigacoes": "origens_ligacoes",
}


def read(spark, name: str, path: str, columns=None):
    """Read a warehouse table with its declared schema and char-column
    trimming."""
    from arrears.sources.io import read_source
    return read_source(spark, path, schema=schema(name), columns=columns,
                       char_cols=CHAR_COLUMNS.get(name, ()))
