"""Result columns of every registered query."""

from __future__ import annotations

from checks.spec import Spec, spec

_PERSON_RAW = (
    "matricula:int nome_ficticio area cargo senioridade data_admissao tempo_casa_meses:int idade:int genero raca_cor "
    "cidade salario_mensal:d4 engajamento_score_base:d4 performance_score:d4 produtividade_index_base:d4 "
    "gestor_matricula:int status data_desligamento tipo_desligamento motivo_desligamento")
_CHECK = "check observed:d6 limit passed:flag"
_COHORT = (
    "competencia area admissoes:int engajamento_medio:d6 salario_medio:d6 performance_medio:d6 desligamentos:int "
    "voluntarios:int")
_MEMBER = "sk_colaborador nk_matricula:int cargo senioridade sk_area:int"
_VERSIONS = (f"{_MEMBER} genero raca_cor cidade faixa_etaria faixa_salarial data_inicio_vigencia data_fim_vigencia "
             "e_registro_atual:flag versao:int")

COLUMNS: dict[str, Spec] = {name: spec(text) for name, text in {
    "bronze_profile": "column nulls:int",
    "attach_departures": _PERSON_RAW,
    "dedup_exact": _PERSON_RAW,
    "dedup_latest": _PERSON_RAW,
    "dedup_first": _PERSON_RAW,
    "normalize_area": _PERSON_RAW,
    "count_unknown_area": "rows:int",
    "null_out_of_range": "matricula:int engajamento_score_base:d4",
    "impute_engagement": "matricula:int area engajamento_score_base:d4",
    "impute_salary": "matricula:int area senioridade salario_mensal:d4",
    "fix_salary_scale": "matricula:int senioridade salario_mensal:d4",
    "label_missing": "matricula:int genero raca_cor",
    "parse_dates": "matricula:int data_admissao data_desligamento",
    "repair_interval": "matricula:int data_admissao data_desligamento tipo_desligamento motivo_desligamento status",
    "replace_status": "matricula:int status",
    "silver": _PERSON_RAW,
    "quality_log": "step rows:int",
    "unexpected_nulls": "unexpected_nulls:int",
    "status_counts": "status rows:int",
    "bronze_gate": _CHECK,
    "quality_sla": "metric observed:d6 target:d4 alert:d4 state",
    "expectations_bronze": _CHECK,
    "expectations_silver": _CHECK,
    "protect_pii": "matricula nome_ficticio area gestor_matricula status",
    "suppress_small_cells": "area raca_cor headcount:int salario_medio:d4",
    "check_pk": "matricula:int rows:int",
    "check_fk": "gestor_matricula:int rows:int",
    "values_outside": "area",
    "group_median": "area senioridade median:d4",
    "active_at": "matricula:int area data_admissao data_desligamento",
    "monthly_series":
        "competencia headcount_total:int admissoes:int desligamentos:int desligamentos_voluntarios:int "
        "desligamentos_involuntarios:int turnover_mensal_pct:d2 custo_folha_total:d2 engajamento_medio:d2 enps:d1 "
        "produtividade_index:d1 performance_medio:d2",
    "granular_series":
        "competencia area senioridade genero headcount:int desligamentos:int desligamentos_voluntarios:int "
        "engajamento_medio:d2 salario_medio:d2 performance_medio:d2 produtividade_medio:d1",
    "headcount_by_area": "area headcount:int",
    "productivity_by_area": "competencia area produtividade_index:d1 headcount:int",
    "admissions_cohort":
        "competencia area admissoes:int engajamento_medio:d6 salario_medio:d6 performance_medio:d6",
    "departures_by_area": "competencia area desligamentos:int voluntarios:int",
    "cohort_join": _COHORT,
    "cohort_join_strict": _COHORT,
    "area_risk_proxy":
        "area headcount:int engajamento_medio:d6 salario_medio:d6 performance_medio:d6 engajamento_std:d6 "
        "risco_proxy:d6",
    "nine_box": "perf_box:int pot_box:int area headcount:int engajamento_medio:d6 salario_medio:d6",
    "nine_box_view": "area senioridade perf_box:int pot_box:int headcount:int",
    "root_cause":
        "causa_raiz_desc area_predominante total_desligamentos:int pct_do_total_voluntario:d1 itens_configuracao",
    "action_plan": "id causa_raiz area_foco acao_proposta horizonte_dias:int prioridade responsavel",
    "action_details": "plano_id what why who where when how",
    "improvement_cycles": "causa_raiz plan do check act",
    "kpi_cover":
        "competencia headcount_atual:int turnover_ltm_pct:d1 enps_atual:d1 produtividade_atual:d1 "
        "custo_folha_atual:d2 turnover_na_meta:flag enps_na_meta:flag",
    "monthly_kpis": "competencia headcount_ativo:int turnover_mensal_pct:d2 engajamento_medio:d2 enps:d1",
    "dimension_members": "dimension member",
    "workforce_plan": "competencia area headcount_planejado:int",
    "plan_gap": "competencia area headcount_planejado:int headcount_projetado:int gap:int",
    "dim_date":
        "sk_data:int data_completa ano:int semestre:int trimestre:int mes:int nome_mes semana_ano:int dia_mes:int "
        "dia_semana:int nome_dia_semana e_fim_de_semana:flag e_feriado_nacional:flag competencia",
    "dim_area": "sk_area:int area classificacao_risco headcount:int",
    "dim_motivo": "sk_motivo:int motivo categoria_rca e_retencao_possivel:flag desligamentos:int",
    "scd2_employee":
        "matricula:int cargo senioridade area valid_from valid_to is_current:flag version:int",
    "dim_employee": _VERSIONS,
    "dim_employee_incremental": _VERSIONS,
    "fact_departure":
        "sk_desligamento sk_colaborador sk_area:int sk_motivo:int sk_data_deslig:int sk_data_admissao:int "
        "tempo_casa_dias:int tempo_casa_meses:int salario_na_saida:d2 engajamento_ultimo:d2 performance_ultimo:d2 "
        "custo_estimado_turnover:d2 e_early_turnover:flag e_late_turnover:flag e_top_talent:flag",
    "fact_headcount":
        "sk_headcount sk_area:int competencia senioridade headcount:int admissoes:int desligamentos:int desligamentos_vol:int "
        "turnover_mensal_pct:d2 engajamento_medio:d2 salario_medio:d2 performance_medio:d2 enps:d1 custo_folha:d2",
    "turnover_ltm":
        "area classificacao_risco total_desligamentos:int desligamentos_voluntarios:int headcount_medio:d4 "
        "turnover_ltm_pct:d1 turnover_ltm_pct_area:d1 pct_voluntario:d1",
    "turnover_cost_ltm":
        "area custo_total_turnover:d2 total_desligamentos:int custo_medio_por_desligamento:d4",
    "departure_careers":
        "sk_desligamento sk_colaborador senioridade_inicial senioridade_na_saida versoes:int dias_desde_mudanca:int",
    "departure_profiles":
        "senioridade_inicial senioridade_na_saida categoria_rca desligamentos:int com_mudanca:int "
        "dias_desde_mudanca_medio:d4 early_turnover:int custo_total_turnover:d2",
    "star_constraints": "constraint_name violations:int",
    "funnel": "dia view:int click:int signup:int purchase:int view_to_click:d4 click_to_signup:d4 "
              "signup_to_purchase:d4 mean_days:d4",
    "attrition_labels": "matricula:int label:d1 tempo_casa_meses_ref:d1",
    "base_rate": "eligible:int leavers:int taxa_attrition_base:d1",
    "risk_band": "matricula:int score:d4 faixa_risco",
    "rule_risk_by_area": "area headcount:int risco_medio:d3 qtd_alto_risco:int",
    "rule_top_risk":
        "matricula:int area cargo senioridade tempo_casa_meses_ref:int engajamento_score_base:d4 "
        "performance_score:d4 risco_attrition_score:d4",
    "rule_band_counts": "faixa_risco rows:int",
    "person_bands": "matricula:int faixa_etaria faixa_salarial",
    "retrain_days": "competencia dia",
    "incremental_ingest": _PERSON_RAW + " export_date",
    "refreshed_exports": "export_date senioridade headcount:int folha:d2",
    "intake_quarantine": "export_date rows:int malformed:int bad_keys:int silver_rows:int folha:d2",
    "funnel_by_cohort": "competencia segmento view:int click:int signup:int purchase:int view_to_click:d4 "
                        "click_to_signup:d4 signup_to_purchase:d4 mean_days:d3",
    "stratified_split": "matricula:int label:int in_train:flag",
    "encode_city": "matricula:int cidade cidade_mean:d9",
    "city_means": "cidade other:flag mean:d9",
    "rule_auc": "roc_auc:d9 positives:int negatives:int",
    "quality_sla_model": "metric observed:d6 target:d4 alert:d4 state",
    "late_export": "matricula:int area senioridade export_date",
    "csv_roundtrip": _PERSON_RAW,
    "silver_partitions": "area rows:int",
}.items()}
