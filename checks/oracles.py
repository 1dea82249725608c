"""The same questions as SQL over the driver's tables, written without the library's rewrites: range joins instead of
running sums, windows instead of aggregations, `median()` instead of cells."""

from __future__ import annotations

from checks.columns import COLUMNS
from checks.queries import EXPORTS, LABEL_DATE, MIN_CELL, PLAN_DATE, SERIES, STAGES
from checks.spec import shape_sql
from rollcall.fixed_values import (
    ACTION_OWNERS, AREA_ALIASES, AREAS, DIM_AREA, DIM_REASON, MONTH_NAMES, REASON_ACTION, REASON_ITEMS,
    SALARY_RANGE, WEEKDAY_NAMES)
from rollcall.schema import COLUMNS as PERSON
from rollcall.sources.trade_view import REFERENCE_DATE, SNAPSHOT_DATES


def _value(v: object) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    return str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    listed = ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {listed}) AS t({columns})"


ALL = ", ".join(PERSON)
AREA_LIST = ", ".join(_value(a) for a in AREAS)

RAW = """WITH base AS (
  SELECT CAST(o_orderkey AS BIGINT) k, CAST(o_custkey AS BIGINT) c, CAST(o_orderdate AS DATE) d, o_orderstatus st,
    n_name cidade,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED','5-LOW') THEN 'Júnior/Pleno'
         WHEN o_orderpriority = '1-URGENT' THEN 'Liderança' ELSE 'Sênior/Especialista' END senioridade,
    CASE o_custkey % 10 WHEN 0 THEN 'Tecnologia' WHEN 1 THEN 'Comercial/Varejo' WHEN 2 THEN 'Operações'
         WHEN 3 THEN 'Risco e Crédito' WHEN 4 THEN 'Atendimento/CX' WHEN 5 THEN 'Financeiro' WHEN 6 THEN 'RH'
         WHEN 7 THEN 'Jurídico/Compliance' WHEN 8 THEN 'Marketing' ELSE 'Produtos Digitais' END area
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
ev AS (
  SELECT *, CASE WHEN st = 'F' AND k % 211 = 0 THEN d + CAST(-400 AS INT)
                 WHEN st = 'F' AND d + CAST((k*17) % 1500 AS INT) <= DATE '2001-08-01'
                 THEN d + CAST((k*17) % 1500 AS INT) END dd FROM base),
one AS (
  SELECT k, k + 100000 matricula, 'Colaborador_' || CAST(k + 100000 AS STRING) nome_ficticio,
    CASE WHEN k % 97 = 0 THEN upper(area) || ' ' ELSE area END area,
    'Cargo_' || CAST(c % 4 AS STRING) cargo, senioridade, CAST(d AS STRING) data_admissao,
    CAST((2001 - year(d))*12 + 8 - month(d) AS INT) tempo_casa_meses, CAST(19 + c % 50 AS INT) idade,
    CASE WHEN k % 100 < 49 THEN 'Feminino' WHEN k % 100 < 98 THEN 'Masculino'
         WHEN k % 100 = 98 THEN 'Não-binário/Outro' END genero,
    CASE WHEN k % 50 < 25 THEN 'Branca' WHEN k % 50 < 39 THEN 'Parda' WHEN k % 50 < 46 THEN 'Preta'
         WHEN k % 50 < 48 THEN 'Amarela' END raca_cor,
    cidade,
    CASE WHEN k % 173 = 0 THEN CAST(NULL AS DOUBLE)
         ELSE CAST((CASE senioridade WHEN 'Júnior/Pleno' THEN 5500 WHEN 'Liderança' THEN 22000 ELSE 11000 END
                    + (k*37) % 3000) * (CASE WHEN k % 331 = 0 THEN 100 ELSE 1 END) AS DOUBLE) END salario_mensal,
    CASE WHEN k % 19 = 0 THEN CAST(NULL AS DOUBLE) WHEN k % 311 = 0 THEN CAST(99 AS DOUBLE)
         WHEN k % 409 = 0 THEN CAST(-1 AS DOUBLE)
         ELSE CAST(10 + (c*7 + k*3) % 91 AS DOUBLE) / CAST(10 AS DOUBLE) END engajamento_score_base,
    CAST(2 + (k*3) % 9 AS DOUBLE) / CAST(2 AS DOUBLE) performance_score,
    CAST(40 + (k*13) % 111 AS DOUBLE) produtividade_index_base,
    CASE WHEN senioridade <> 'Liderança' THEN 100000 + k - k % 10 END gestor_matricula,
    CASE WHEN dd IS NULL THEN 'Ativo' ELSE 'Desligado' END status, CAST(dd AS STRING) data_desligamento,
    CASE WHEN dd IS NULL THEN NULL WHEN (k*31) % 100 < 68 THEN 'Voluntário' ELSE 'Involuntário' END
      tipo_desligamento,
    CASE WHEN dd IS NULL THEN NULL ELSE CASE (k*7) % 9 WHEN 0 THEN 'Proposta salarial melhor'
         WHEN 1 THEN 'Falta de plano de carreira' WHEN 2 THEN 'Conflito com liderança' WHEN 3 THEN 'Mudança de cidade'
         WHEN 4 THEN 'Questões de saúde' WHEN 5 THEN 'Reestruturação' WHEN 6 THEN 'Baixa performance'
         WHEN 7 THEN 'Aposentadoria' ELSE 'Insatisfação com cultura' END END motivo_desligamento
  FROM ev),
older AS (
  SELECT k, matricula, nome_ficticio, area, cargo, senioridade,
    CAST(CAST(data_admissao AS DATE) + CAST(-365 AS INT) AS STRING) data_admissao,
    tempo_casa_meses, idade, genero, raca_cor, cidade, salario_mensal, engajamento_score_base, performance_score,
    produtividade_index_base, gestor_matricula, status, data_desligamento, tipo_desligamento, motivo_desligamento
  FROM one WHERE k % 353 = 0),
colaboradores_raw AS (
  SELECT * FROM one UNION ALL SELECT * FROM one WHERE k % 89 = 0 UNION ALL SELECT * FROM older)"""

NAMES = f"""{RAW},
area_names AS ({_values([(a.upper(), a) for a in AREAS] + list(AREA_ALIASES.items()), 'spelling, known')}),
ceilings AS ({_values([(level, high) for level, (_, high) in SALARY_RANGE.items()], 'level, ceiling')}),
raw AS (SELECT {ALL} FROM colaboradores_raw)"""

NORMAL = f"""{NAMES},
normal AS (SELECT r.* REPLACE (coalesce(n.known, trim(r.area)) AS area)
           FROM raw r LEFT JOIN area_names n ON upper(trim(r.area)) = n.spelling)"""

_CLEAN = """
{name}_one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY data_admissao DESC NULLS LAST) rn
    FROM (SELECT DISTINCT * FROM {source})) WHERE rn = 1),
{name}_fixed AS (
  SELECT o.* REPLACE (
    coalesce(n.known, trim(o.area)) AS area,
    CASE WHEN engajamento_score_base BETWEEN 0 AND 10 THEN engajamento_score_base END AS engajamento_score_base,
    CASE WHEN salario_mensal > 3 * coalesce(c.ceiling, 1000000000) THEN salario_mensal / 100
         ELSE salario_mensal END AS salario_mensal,
    coalesce(genero, 'Não informado') AS genero, coalesce(raca_cor, 'Não informado') AS raca_cor,
    CAST(data_admissao AS DATE) AS data_admissao, CAST(data_desligamento AS DATE) AS data_desligamento)
  FROM {name}_one o LEFT JOIN area_names n ON upper(trim(o.area)) = n.spelling
    LEFT JOIN ceilings c ON o.senioridade = c.level),
{name}_engagement AS (SELECT {within} area, median(engajamento_score_base) m FROM {name}_fixed GROUP BY ALL),
{name}_salary AS (SELECT {within} area, senioridade, median(salario_mensal) m FROM {name}_fixed GROUP BY ALL),
{name} AS (
  SELECT f.* REPLACE (
    coalesce(engajamento_score_base, e.m) AS engajamento_score_base, coalesce(salario_mensal, s.m) AS salario_mensal,
    CASE WHEN NOT coalesce(data_desligamento < data_admissao, FALSE) THEN data_desligamento END AS data_desligamento,
    CASE WHEN NOT coalesce(data_desligamento < data_admissao, FALSE) THEN tipo_desligamento END AS tipo_desligamento,
    CASE WHEN NOT coalesce(data_desligamento < data_admissao, FALSE) THEN motivo_desligamento END
      AS motivo_desligamento,
    CASE WHEN data_desligamento < data_admissao THEN 'Ativo' ELSE status END AS status)
  FROM {name}_fixed f LEFT JOIN {name}_engagement e USING ({within} area)
    LEFT JOIN {name}_salary s USING ({within} area, senioridade))"""

SILVER = NAMES + "," + _CLEAN.format(name="silver", source="raw", keys="matricula", within="")

MONTHS = f"""{SILVER},
months AS (
  SELECT CAST(m AS DATE) AS mes, last_day(m) AS fim, strftime(m, '%Y-%m') AS competencia
  FROM generate_series(DATE '1998-09-01', DATE '{SERIES[1]}', INTERVAL 1 MONTH) AS g(m)),
active AS (
  SELECT m.mes, m.competencia, s.* FROM months m JOIN silver s
    ON s.data_admissao <= m.fim AND (s.data_desligamento IS NULL OR s.data_desligamento > m.fim)),
opened AS (
  SELECT m.mes, m.competencia, s.* FROM months m JOIN silver s
    ON s.data_admissao <= m.mes AND (s.data_desligamento IS NULL OR s.data_desligamento > m.mes)),
gone AS (
  SELECT m.competencia, s.* FROM months m JOIN silver s ON strftime(s.data_desligamento, '%Y-%m') = m.competencia),
came AS (
  SELECT m.competencia, s.* FROM months m JOIN silver s ON strftime(s.data_admissao, '%Y-%m') = m.competencia)"""


def _mean(column: str) -> str:
    kind = "DECIMAL(18,2)" if column.startswith("salario") else "DECIMAL(18,6)"
    return f"CAST(sum(CAST({column} AS {kind})) AS DOUBLE) / nullif(count({column}), 0)"


def _rounded(column: str, places: int) -> str:
    """Mean of positive values rounded half up in whole numbers, as doubles can miss an exact half."""
    n, unit = f"CAST(count({column}) AS HUGEINT)", 10 ** (6 - places)
    total = f"CAST(sum(CAST({column} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"
    return f"CAST((2 * {total} + {n} * {unit}) // nullif(2 * {n} * {unit}, 0) AS DOUBLE) / {10 ** places}"


def _turnover(exits: str, opening: str) -> str:
    base = f"greatest({opening}, 1)"
    return f"CAST((2 * {exits} * 10000 + {base}) // (2 * {base}) AS DOUBLE) / 100"


def _index(column: str, factor: int, shift: str, low: int, high: int) -> str:
    """factor * mean + shift within [low, high], one decimal, half away from zero, in whole numbers."""
    n = f"CAST(count({column}) AS HUGEINT)"
    total = f"CAST(sum(CAST({column} AS DECIMAL(18,6))) * 1000000 AS HUGEINT)"
    over, under = f"({factor} * {total} + ({shift}) * {n} * 1000000)", f"({n} * 1000000)"
    rounded = f"sign({over}) * ((20 * abs({over}) + {under}) // nullif(2 * {under}, 0))"
    return f"CASE WHEN {n} > 0 THEN greatest({low}, least({high}, CAST({rounded} AS DOUBLE) / 10)) END"


_ENPS = _index(
    "engajamento_score_base", 18, "-90 + CASE max(year(mes)) WHEN 2024 THEN -3 WHEN 2025 THEN 0 ELSE 4 END", -100, 100)
_PRODUCTIVITY = _index("performance_score", 12, "49", 60, 135)

SERIES_CTE = f"""{MONTHS},
by_month AS (
  SELECT mes, competencia, count(*) AS hc, {_ENPS} AS enps, {_PRODUCTIVITY} AS prod,
    {_rounded('engajamento_score_base', 2)} AS e2, {_rounded('performance_score', 2)} AS p2,
    CAST(sum(CAST(salario_mensal AS DECIMAL(18,2))) AS DOUBLE) AS payroll FROM active GROUP BY ALL),
serie AS (
  SELECT competencia, coalesce(hc, 0) AS headcount_total,
    (SELECT count(*) FROM came c WHERE c.competencia = m.competencia) AS admissoes,
    (SELECT count(*) FROM gone c WHERE c.competencia = m.competencia) AS desligamentos,
    (SELECT count(*) FROM gone c WHERE c.competencia = m.competencia AND tipo_desligamento = 'Voluntário')
      AS desligamentos_voluntarios,
    (SELECT count(*) FROM gone c WHERE c.competencia = m.competencia AND tipo_desligamento = 'Involuntário')
      AS desligamentos_involuntarios,
    {_turnover('(SELECT count(*) FROM gone c WHERE c.competencia = m.competencia)',
               '(SELECT count(*) FROM opened c WHERE c.competencia = m.competencia)')} AS turnover_mensal_pct,
    coalesce(payroll, 0) AS custo_folha_total, e2 AS engajamento_medio,
    enps, prod AS produtividade_index,
    p2 AS performance_medio
  FROM months m LEFT JOIN by_month b USING (mes, competencia))"""

CAUSES = f"""{SILVER},
left_by AS (SELECT * FROM silver WHERE status = 'Desligado'),
voluntary AS (
  SELECT motivo_desligamento AS reason, count(*) AS n FROM left_by
  WHERE tipo_desligamento = 'Voluntário' AND motivo_desligamento IS NOT NULL GROUP BY 1),
main_area AS (
  SELECT reason, area FROM (
    SELECT motivo_desligamento AS reason, area,
      row_number() OVER (PARTITION BY motivo_desligamento ORDER BY count(*) DESC, area) AS rn
    FROM left_by GROUP BY 1, 2) WHERE rn = 1),
items AS ({_values([(k, '|'.join(v)) for k, v in REASON_ITEMS.items()], 'reason, items')}),
actions AS ({_values(list(REASON_ACTION.items()), 'reason, action')}),
causes AS (
  SELECT v.reason AS causa_raiz_desc, coalesce(area, 'Diversas') AS area_predominante, n AS total_desligamentos,
    round(n / CAST((SELECT sum(n) FROM voluntary) AS DOUBLE) * 100, 1) AS pct_do_total_voluntario,
    coalesce(items, 'Processo-RH-Generico') AS itens_configuracao
  FROM voluntary v LEFT JOIN main_area a USING (reason) LEFT JOIN items i USING (reason))"""

DIMS = f"""{MONTHS},
dim_area AS ({_values(DIM_AREA, 'sk_area, area, diretoria, vice_presidencia, centro_de_custo, classificacao_risco')}),
dim_reason AS ({_values(DIM_REASON, 'sk_motivo, motivo, categoria_rca, tipo, e_retencao_possivel')})"""

SCD = f"""{DIMS},
taken AS ({_values([(d,) for d in SNAPSHOT_DATES], 'day')}),
snaps AS (
  SELECT s.* REPLACE (
    CASE WHEN (matricula - 100000) % 7 = 0 AND day >= '{SNAPSHOT_DATES[1]}' THEN
      CASE senioridade WHEN 'Júnior/Pleno' THEN 'Sênior/Especialista' WHEN 'Sênior/Especialista' THEN 'Liderança'
        ELSE senioridade END ELSE senioridade END AS senioridade,
    CASE WHEN (matricula - 100000) % 11 = 0 AND day >= '{SNAPSHOT_DATES[2]}' THEN 'Operações' ELSE area END AS area),
    CAST(day AS DATE) AS day FROM silver s, taken),
marked AS (
  SELECT *, lag(day) OVER w IS NULL OR cargo IS DISTINCT FROM lag(cargo) OVER w
    OR senioridade IS DISTINCT FROM lag(senioridade) OVER w OR area IS DISTINCT FROM lag(area) OVER w AS changed
  FROM snaps WINDOW w AS (PARTITION BY matricula ORDER BY day)),
versions AS (
  SELECT *, day AS valid_from, lead(day) OVER w - 1 AS valid_to, lead(day) OVER w IS NULL AS is_current,
    row_number() OVER w AS version
  FROM marked WHERE changed WINDOW w AS (PARTITION BY matricula ORDER BY day)),
employees AS (
  SELECT CAST(matricula AS VARCHAR) || '-' || CAST(version AS VARCHAR) AS sk_colaborador, matricula AS nk_matricula, cargo, senioridade, sk_area, genero,
    raca_cor, cidade,
    CASE WHEN idade BETWEEN 18 AND 24 THEN '18-24' WHEN idade BETWEEN 25 AND 34 THEN '25-34'
      WHEN idade BETWEEN 35 AND 44 THEN '35-44' WHEN idade BETWEEN 45 AND 54 THEN '45-54'
      WHEN idade >= 55 THEN '55+' END AS faixa_etaria,
    CASE WHEN salario_mensal <= 5000 THEN 'Até 5k' WHEN salario_mensal < 10000 THEN '5-10k'
      WHEN salario_mensal < 20000 THEN '10-20k' WHEN salario_mensal >= 20000 THEN '20k+' END AS faixa_salarial,
    valid_from AS data_inicio_vigencia, valid_to AS data_fim_vigencia, is_current AS e_registro_atual, version AS versao
  FROM versions LEFT JOIN dim_area USING (area)),
tenured AS (
  SELECT *, (year(data_desligamento) - year(data_admissao)) * 12 + month(data_desligamento) - month(data_admissao)
    AS casa FROM silver WHERE data_desligamento IS NOT NULL),
fact AS (
  SELECT CAST(matricula AS VARCHAR) || '-' || CAST(data_desligamento AS VARCHAR) AS sk_desligamento,
    (SELECT min_by(sk_colaborador, versao) FROM employees e WHERE e.nk_matricula = t.matricula
      AND (e.data_fim_vigencia IS NULL OR e.data_fim_vigencia >= t.data_desligamento)) AS sk_colaborador,
    sk_area, sk_motivo,
    CAST(strftime(data_desligamento, '%Y%m%d') AS BIGINT) AS sk_data_deslig,
    CAST(strftime(data_admissao, '%Y%m%d') AS BIGINT) AS sk_data_admissao,
    data_desligamento - data_admissao AS tempo_casa_dias, casa AS tempo_casa_meses,
    salario_mensal AS salario_na_saida, CAST(engajamento_score_base AS DECIMAL(4,2)) AS engajamento_ultimo,
    performance_score AS performance_ultimo,
    CAST(CAST(salario_mensal AS DECIMAL(18,2)) * 1.5 AS DECIMAL(12,2)) AS custo_estimado_turnover,
    casa < 6 AS e_early_turnover, casa > 48 AS e_late_turnover,
    performance_score >= 4 AND engajamento_score_base >= 7.5 AND casa <= 60 AS e_top_talent
  FROM tenured t LEFT JOIN dim_area USING (area) LEFT JOIN dim_reason r ON r.motivo = t.motivo_desligamento)"""

CAREERS = f"""{SCD},
careers AS (
  SELECT f.*, (SELECT s.senioridade FROM employees s WHERE s.nk_matricula = e.nk_matricula AND s.versao = 1)
      AS senioridade_inicial,
    e.senioridade AS senioridade_na_saida, coalesce(e.versao, 0) AS versoes,
    CASE WHEN e.versao > 1 THEN CAST(strptime(CAST(sk_data_deslig AS VARCHAR), '%Y%m%d') AS DATE)
      - CAST(e.data_inicio_vigencia AS DATE) END AS dias_desde_mudanca
  FROM fact f LEFT JOIN employees e USING (sk_colaborador))"""

FACT_HC = f"""{DIMS},
hc AS (
  SELECT mes, competencia, area, senioridade, count(*) AS headcount, {_ENPS} AS enps,
    {_rounded('engajamento_score_base', 2)} AS e2, {_rounded('salario_mensal', 2)} AS s2,
    {_rounded('performance_score', 2)} AS p2, CAST(sum(CAST(salario_mensal AS DECIMAL(18,2))) AS DOUBLE) AS folha FROM active GROUP BY ALL),
op AS (SELECT competencia, area, senioridade, count(*) AS opening FROM opened GROUP BY ALL),
ins AS (SELECT competencia, area, senioridade, count(*) AS admissoes FROM came GROUP BY ALL),
outs AS (SELECT competencia, area, senioridade, count(*) AS desligamentos,
         count(*) FILTER (tipo_desligamento = 'Voluntário') AS vol FROM gone GROUP BY ALL),
fact_hc AS (
  SELECT CAST(to_json([competencia, area, senioridade]) AS VARCHAR) AS sk_headcount, sk_area, competencia, senioridade,
    coalesce(headcount, 0) AS headcount, coalesce(admissoes, 0) AS admissoes,
    coalesce(desligamentos, 0) AS desligamentos, coalesce(vol, 0) AS desligamentos_vol,
    {_turnover('coalesce(desligamentos, 0)', 'coalesce(opening, 0)')} AS turnover_mensal_pct,
    e2 AS engajamento_medio, s2 AS salario_medio, p2 AS performance_medio,
    enps, folha AS custo_folha
  FROM hc FULL JOIN ins USING (competencia, area, senioridade) FULL JOIN outs USING (competencia, area, senioridade)
    LEFT JOIN op USING (competencia, area, senioridade) LEFT JOIN dim_area USING (area))"""

STAR = f"""{SCD}{FACT_HC.removeprefix(DIMS)},
days AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_data FROM generate_series(
    (SELECT least(min(data_admissao), min(data_desligamento)) FROM silver),
    (SELECT greatest(max(data_admissao), max(data_desligamento)) FROM silver), INTERVAL 1 DAY) AS g(d))"""


def _no_parent(name: str, child: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, count(DISTINCT {column}) AS violations FROM {child}
        WHERE {column} NOT IN (SELECT {key} FROM {parent})"""


def _not_key(name: str, table: str, columns: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, count(*) AS violations
        FROM (SELECT 1 FROM {table} GROUP BY {columns} HAVING count(*) > 1)"""


def _nulls(name: str, table: str, columns: str) -> str:
    found = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns.split())
    return f"SELECT '{name}' AS constraint_name, {found} AS violations FROM {table}"


def _checks(source: str, lines: list[tuple[str, str, str, str]]) -> str:
    """UNION of (check, expression, operator, limit) over one source."""
    sign = {"==": "="}
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", CAST({expr} AS DOUBLE) AS observed, '{op} {limit}' AS \"limit\", "
        f"{expr} {sign.get(op, op)} {limit} AS passed FROM {source}"
        for name, expr, op, limit in lines)


_SHARE_COPIES = f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {ALL} FROM raw))) / CAST(count(*) AS DOUBLE)"


def _count(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


_RATES = ", ".join(
    f"round(CAST({b} AS DOUBLE) / nullif({a}, 0), 4) AS {a}_to_{b}" for a, b in zip(STAGES, STAGES[1:]))
_FIRSTS = ", ".join(f"min(ts) FILTER (event_type = '{s}') AS t_{s}" for s in STAGES)
_REACHED = ", ".join(f"count(t_{s}) AS {s}" for s in STAGES)

FUNNEL = f"""WITH people AS (
  SELECT CAST(ts AS DATE) AS dia, user_id, {_FIRSTS} FROM events
  WHERE event_type IN ({', '.join(_value(s) for s in STAGES)}) GROUP BY ALL),
counted AS (
  SELECT dia, {_REACHED},
    sum(date_sub('second', t_view, t_purchase)) FILTER (t_purchase >= t_view)
      / CAST(nullif(count(*) FILTER (t_purchase >= t_view), 0) AS DOUBLE) / 86400 AS mean_days
  FROM people GROUP BY 1)"""


def _exports(days: tuple[str, ...]) -> str:
    """Union of exports, each with the promotions it carries."""
    parts = []
    for day in days:
        level = "senioridade" if day == EXPORTS[0] else (
            "CASE WHEN (matricula - 100000) % 7 = 0 THEN 'Liderança' ELSE senioridade END")
        parts.append(f"SELECT raw.* REPLACE ({level} AS senioridade), DATE '{day}' AS export_date FROM raw")
    return f"{NAMES},\nhistory AS ({' UNION ALL '.join(parts)})," + _CLEAN.format(
        name="cleaned", source="history", keys="matricula, export_date", within="export_date, ")


_QUARANTINE = f"""{NAMES},
landed AS (
  SELECT *, (matricula - 100000) % 31 = 0 AS bad_key,
    (matricula - 100000) % 31 = 0 OR ((matricula - 100000) % 29 = 0 AND salario_mensal IS NOT NULL) AS bad,
    CASE WHEN matricula % 2 = 0 THEN DATE '{EXPORTS[0]}' ELSE DATE '{EXPORTS[1]}' END AS export_date FROM raw),
history AS (SELECT * EXCLUDE (bad, bad_key) FROM landed WHERE NOT bad),""" + _CLEAN.format(
    name="cleaned", source="history", keys="matricula, export_date", within="export_date, ")


_COHORTS = f"""{SILVER},
adm AS (
  SELECT strftime(data_admissao, '%Y-%m') AS competencia, area, count(matricula) AS admissoes,
    {_mean('engajamento_score_base')} AS engajamento_medio, {_mean('salario_mensal')} AS salario_medio,
    {_mean('performance_score')} AS performance_medio
  FROM silver WHERE status IN ('Ativo', 'Desligado') GROUP BY 1, 2),
dep AS (
  SELECT strftime(data_desligamento, '%Y-%m') AS competencia, area, count(matricula) AS desligamentos,
    count(*) FILTER (tipo_desligamento = 'Voluntário') AS voluntarios
  FROM silver WHERE data_desligamento IS NOT NULL GROUP BY 1, 2)"""

_BOX = """CASE WHEN performance_score >= 4 THEN 3 WHEN performance_score >= 3 THEN 2 ELSE 1 END AS perf_box,
  CASE WHEN engajamento_score_base >= 7.5 AND tempo_casa_meses <= 60 THEN 3
       WHEN engajamento_score_base >= 6 THEN 2 ELSE 1 END AS pot_box"""

_LABELS = f"""{SILVER},
labelled AS (
  SELECT matricula, CASE WHEN data_desligamento > DATE '{LABEL_DATE}'
      AND data_desligamento <= DATE '{LABEL_DATE}' + 365 AND tipo_desligamento = 'Voluntário' THEN 1.0 ELSE 0.0 END
      AS label,
    round_even((DATE '{LABEL_DATE}' - data_admissao) / 30.0, 0) AS tempo_casa_meses_ref
  FROM silver WHERE data_admissao <= DATE '{LABEL_DATE}'
    AND (data_desligamento IS NULL OR data_desligamento > DATE '{LABEL_DATE}'))"""


_RULED = f"""{SILVER},
ruled AS (
  SELECT *, CASE WHEN score > 0 AND score <= 0.15 THEN 'Baixo' WHEN score > 0.15 AND score <= 0.35 THEN 'Médio'
    WHEN score > 0.35 AND score <= 1 THEN 'Alto' END AS faixa_risco
  FROM (SELECT *, round((10 - engajamento_score_base) / 20, 4) AS score FROM silver WHERE status = 'Ativo'))"""


_SLA = f"""
        SELECT 'key_completeness' AS metric, k AS observed, 1.0 AS target, 0.995 AS alert,
          CASE WHEN k < 0.995 THEN 'alert' WHEN k >= 1 THEN 'ok' ELSE 'warn' END AS state
        FROM (SELECT count(matricula) / CAST(count(*) AS DOUBLE) AS k FROM raw)
        UNION ALL SELECT 'copies_share', k, 0.005, 0.01,
          CASE WHEN k > 0.01 THEN 'alert' WHEN k < 0.005 THEN 'ok' ELSE 'warn' END
        FROM (SELECT {_SHARE_COPIES} AS k FROM raw)
        UNION ALL SELECT 'engagement_in_range', k, 1.0, 0.99,
          CASE WHEN k < 0.99 THEN 'alert' WHEN k >= 1 THEN 'ok' ELSE 'warn' END
        FROM (SELECT {_count('engajamento_score_base BETWEEN 0 AND 10')}
              / CAST(count(engajamento_score_base) AS DOUBLE) AS k FROM raw)"""

# The first event of the first stage, then for each person and stage the first event not before the one reached.
_STEPS = f"""WITH s0 AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = '{STAGES[0]}' AND user_id IS NOT NULL
  GROUP BY 1), """ + ", ".join(
    f"""s{k} AS (SELECT *, (SELECT min(e.ts) FROM events e WHERE e.user_id = p.user_id AND e.event_type = '{s}'
      AND e.ts >= p.t{k - 1}) AS t{k} FROM s{k - 1} p)""" for k, s in enumerate(STAGES) if k)

_AUC = f"""{_LABELS},
rated AS (SELECT label, round((10 - s.engajamento_score_base) / 20, 4) AS score
          FROM labelled JOIN silver s USING (matricula)),
ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM rated
  WHERE score IS NOT NULL),
measured AS (
  SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
    (sum(place) FILTER (label = 1) - positives * (positives + 1) / 2.0) / nullif(positives * negatives, 0) AS roc_auc
  FROM ranked)"""

_FOLDED = f"""{_LABELS},
people AS (
  SELECT matricula, s.cidade, label, CAST('0x' || substr(sha256('42|' || matricula), 1, 8) AS BIGINT) % 5 AS fold
  FROM labelled JOIN silver s USING (matricula))"""


def _plan(first: str, base: str) -> str:
    return f"""SELECT strftime(DATE '{first}' + to_months(CAST(i - 1 AS INT)), '%Y-%m') AS competencia, area,
      round(coalesce(b.hc, 50) * pow(1 + 0.045 / 12, i), 0) AS headcount_planejado
    FROM dim_area LEFT JOIN ({base}) b USING (area), generate_series(1, 6) AS g(i)"""


_NULL_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM raw" for c in PERSON)
_REQUIRED_NULLS = " + ".join(
    f"CAST({c} IS NULL AS INT)" for c in PERSON
    if c not in ("gestor_matricula", "data_desligamento", "tipo_desligamento", "motivo_desligamento"))
_NAME_CASE = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(MONTH_NAMES, 1))
_DAY_CASE = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(WEEKDAY_NAMES))
_OWNER_CASE = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(ACTION_OWNERS))

LOG = f"""{SILVER},
log(step, rows) AS (
  SELECT 'exact_duplicates_removed', (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))
  UNION ALL SELECT 'key_duplicates_removed',
    (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) - (SELECT count(DISTINCT matricula) FROM raw)
  UNION ALL SELECT 'area_normalized', count(*) FROM silver_one o JOIN silver_fixed f USING (matricula) WHERE o.area <> f.area
  UNION ALL SELECT 'area_unknown', count(*) FROM silver_fixed WHERE area NOT IN ({AREA_LIST})
  UNION ALL SELECT 'engagement_out_of_range', count(*) FROM silver_one WHERE engajamento_score_base NOT BETWEEN 0 AND 10
  UNION ALL SELECT 'engagement_imputed', count(*) FROM silver_fixed WHERE engajamento_score_base IS NULL
  UNION ALL SELECT 'salary_scale_fixed', count(*) FROM silver_one o JOIN silver_fixed f USING (matricula)
    WHERE o.salario_mensal <> f.salario_mensal
  UNION ALL SELECT 'salary_imputed', count(*) FROM silver_fixed WHERE salario_mensal IS NULL
  UNION ALL SELECT 'gender_labelled', count(*) FROM silver_one WHERE genero IS NULL
  UNION ALL SELECT 'race_labelled', count(*) FROM silver_one WHERE raca_cor IS NULL
  UNION ALL SELECT 'date_unreadable', count(*) FROM silver_one
    WHERE (data_admissao IS NOT NULL AND try_cast(data_admissao AS DATE) IS NULL)
       OR (data_desligamento IS NOT NULL AND try_cast(data_desligamento AS DATE) IS NULL)
  UNION ALL SELECT 'interval_repaired', count(*) FROM silver_fixed WHERE data_desligamento < data_admissao
  UNION ALL SELECT 'left_without_end_date', count(*) FROM silver
    WHERE status = 'Desligado' AND data_desligamento IS NULL
  UNION ALL SELECT 'silver_rows', count(*) FROM silver)"""

# name: (common table expressions, query)
ORACLES: dict[str, tuple[str, str]] = {
    "bronze_profile": (NAMES, _NULL_COUNTS),
    "attach_departures": (NAMES, """
        SELECT p.* EXCLUDE (data_desligamento, tipo_desligamento, motivo_desligamento, rn), g.* EXCLUDE (m, rn)
        FROM (SELECT *, row_number() OVER (PARTITION BY matricula ORDER BY data_admissao DESC) rn FROM raw) p
        LEFT JOIN (SELECT matricula AS m, data_desligamento, tipo_desligamento, motivo_desligamento, row_number() OVER (
                     PARTITION BY matricula ORDER BY data_desligamento DESC, tipo_desligamento DESC,
                     motivo_desligamento DESC) rn
                   FROM raw WHERE data_desligamento IS NOT NULL) g ON p.matricula = g.m AND g.rn = 1
        WHERE p.rn = 1"""),
    "dedup_exact": (NAMES, "SELECT DISTINCT * FROM raw"),
    "dedup_latest": (NAMES, """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY matricula ORDER BY data_admissao DESC) rn FROM raw) WHERE rn = 1"""),
    "dedup_first": (NAMES, """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY matricula ORDER BY data_admissao) rn FROM raw) WHERE rn = 1"""),
    "normalize_area": (NORMAL, "SELECT * FROM normal"),
    "count_unknown_area": (NAMES, f"SELECT count(*) AS rows FROM raw WHERE area NOT IN ({AREA_LIST})"),
    "null_out_of_range": (NAMES, """SELECT matricula, CASE WHEN engajamento_score_base BETWEEN 0 AND 10
        THEN engajamento_score_base END AS engajamento_score_base FROM raw"""),
    "impute_engagement": (NORMAL, """SELECT matricula, area, coalesce(x, median(x) OVER (PARTITION BY area))
        AS engajamento_score_base FROM (SELECT *, CASE WHEN engajamento_score_base BETWEEN 0 AND 10
        THEN engajamento_score_base END AS x FROM normal)"""),
    "impute_salary": (NORMAL, """SELECT matricula, area, senioridade,
        coalesce(x, median(x) OVER (PARTITION BY area, senioridade)) AS salario_mensal
        FROM (SELECT *, CASE WHEN salario_mensal > 3 * ceiling THEN salario_mensal / 100 ELSE salario_mensal END AS x
              FROM normal JOIN ceilings ON level = senioridade)"""),
    "fix_salary_scale": (NAMES, """SELECT matricula, senioridade, CASE WHEN salario_mensal > 3 * ceiling
        THEN salario_mensal / 100 ELSE salario_mensal END AS salario_mensal
        FROM raw JOIN ceilings ON level = senioridade"""),
    "label_missing": (NAMES, """SELECT matricula, coalesce(genero, 'Não informado') AS genero,
        coalesce(raca_cor, 'Não informado') AS raca_cor FROM raw"""),
    "parse_dates": (NAMES, """SELECT matricula, try_cast(data_admissao AS DATE) AS data_admissao,
        try_cast(data_desligamento AS DATE) AS data_desligamento FROM raw"""),
    "repair_interval": (NAMES, """SELECT matricula, data_admissao,
        CASE WHEN NOT broken THEN data_desligamento END AS data_desligamento,
        CASE WHEN NOT broken THEN tipo_desligamento END AS tipo_desligamento,
        CASE WHEN NOT broken THEN motivo_desligamento END AS motivo_desligamento,
        CASE WHEN broken THEN 'Ativo' ELSE status END AS status
        FROM (SELECT *, coalesce(CAST(data_desligamento AS DATE) < CAST(data_admissao AS DATE), FALSE) AS broken
              FROM raw)"""),
    "replace_status": (NAMES, """SELECT matricula, CASE WHEN CAST(data_desligamento AS DATE)
        < CAST(data_admissao AS DATE) THEN 'Ativo' ELSE status END AS status FROM raw"""),
    "silver": (SILVER, "SELECT * FROM silver"),
    "quality_log": (LOG, "SELECT * FROM log"),
    "unexpected_nulls": (NAMES, f"SELECT sum({_REQUIRED_NULLS}) AS unexpected_nulls FROM raw"),
    "status_counts": (SILVER, "SELECT status, count(*) AS rows FROM silver GROUP BY 1"),
    "bronze_gate": (NAMES, _checks("raw", [
        ("min_rows", "count(*)", ">=", "4000"),
        ("key_nulls", _count("matricula IS NULL"), "==", "0"),
        ("copies_share", _SHARE_COPIES, "<=", "0.01"),
        ("salary_range", _count("salario_mensal NOT BETWEEN 1320 AND 100000"), "<=", "0"),
        ("engagement_range", _count("engajamento_score_base NOT BETWEEN 0 AND 10"), "<=", "0"),
        ("start_date", _count("data_admissao IS NULL OR CAST(data_admissao AS DATE) <= DATE '2000-01-01'"), "==", "0"),
    ])),
    "quality_sla": (NAMES, _SLA),
    "expectations_bronze": (NAMES, _checks("raw", [
        ("min_rows", "count(*)", ">=", "4000"),
        ("not_null:matricula", _count("matricula IS NULL"), "==", "0"),
        ("positive:matricula", _count("matricula <= 0"), "==", "0"),
        ("domain_share:area",
         _count(f"trim(area) NOT IN ({AREA_LIST}, 'TECNOLOGIA', 'tecnologia')") + " / CAST(count(*) AS DOUBLE)",
         "<", "0.05"),
        ("columns", "0 * count(*)", "==", "0"),
        ("copies_share", _SHARE_COPIES, "<=", "0.05"),
    ])),
    "expectations_silver": (SILVER, _checks("silver", [
        ("between:engajamento_score_base", _count("engajamento_score_base NOT BETWEEN 0 AND 10"), "==", "0"),
        ("not_null:engajamento_score_base", _count("engajamento_score_base IS NULL"), "==", "0"),
        ("between:salario_mensal", _count("salario_mensal NOT BETWEEN 1320 AND 100000"), "==", "0"),
        ("order:data_admissao<=data_desligamento", _count("data_desligamento < data_admissao"), "==", "0"),
        ("domain:status", _count("status NOT IN ('Ativo', 'Desligado')"), "==", "0"),
        ("trimmed:area", _count("trim(area) <> area"), "==", "0"),
        ("not_null:genero", _count("genero IS NULL"), "==", "0"),
        ("not_null:raca_cor", _count("raca_cor IS NULL"), "==", "0"),
        ("unique:matricula", "count(*) - count(DISTINCT matricula)", "==", "0"),
        ("max_share:senioridade",
         "(SELECT max(n) FROM (SELECT count(*) AS n FROM silver GROUP BY senioridade)) / CAST(count(*) AS DOUBLE)",
         "<=", "0.7"),
        ("row_ratio", "count(*) / CAST((SELECT count(*) FROM raw) AS DOUBLE)", ">=", "0.85"),
    ])),
    "protect_pii": (SILVER, """SELECT sha256('salt' || CAST(matricula AS VARCHAR)) AS matricula,
        '***' AS nome_ficticio, area, sha256('salt' || CAST(gestor_matricula AS VARCHAR)) AS gestor_matricula, status
        FROM silver"""),
    "suppress_small_cells": (SILVER, f"""SELECT area, raca_cor, CASE WHEN n >= {MIN_CELL} THEN n END AS headcount,
        CASE WHEN n >= {MIN_CELL} THEN s END AS salario_medio
        FROM (SELECT area, raca_cor, count(*) AS n, {_mean('salario_mensal')} AS s FROM silver
              WHERE status = 'Desligado' GROUP BY 1, 2)"""),
    "check_pk": (NAMES, "SELECT matricula, count(*) AS rows FROM raw GROUP BY 1 HAVING count(*) > 1"),
    "check_fk": (SILVER, """SELECT gestor_matricula, count(*) AS rows FROM silver WHERE gestor_matricula IS NOT NULL
        AND gestor_matricula NOT IN (SELECT matricula FROM silver WHERE senioridade = 'Liderança') GROUP BY 1"""),
    "values_outside": (NAMES, f"SELECT DISTINCT area FROM raw WHERE area NOT IN ({AREA_LIST})"),
    "group_median": (NORMAL, "SELECT area, senioridade, median(salario_mensal) AS median FROM normal GROUP BY 1, 2"),
    "active_at": (SILVER, """SELECT * FROM silver WHERE data_admissao <= DATE '2000-06-30'
        AND (data_desligamento IS NULL OR data_desligamento > DATE '2000-06-30')"""),
    "monthly_series": (SERIES_CTE, "SELECT * FROM serie"),
    "granular_series": (MONTHS, f"""
        SELECT a.*, coalesce(g.desligamentos, 0) AS desligamentos, coalesce(g.vol, 0) AS desligamentos_voluntarios
        FROM (SELECT competencia, area, senioridade, genero, count(*) AS headcount,
                {_rounded('engajamento_score_base', 2)} AS engajamento_medio,
                {_rounded('salario_mensal', 2)} AS salario_medio,
                {_rounded('performance_score', 2)} AS performance_medio,
                {_rounded('produtividade_index_base', 1)} AS produtividade_medio
              FROM active GROUP BY ALL) a
        LEFT JOIN (SELECT competencia, area, senioridade, genero, count(*) AS desligamentos,
                     count(*) FILTER (tipo_desligamento = 'Voluntário') AS vol FROM gone GROUP BY ALL) g
          USING (competencia, area, senioridade, genero)"""),
    "headcount_by_area": (SILVER, "SELECT area, count(*) AS headcount FROM silver WHERE status = 'Ativo' GROUP BY 1"),
    "productivity_by_area": (MONTHS, f"""SELECT competencia, area, count(*) AS headcount,
        greatest(50, least(140, {_rounded('produtividade_index_base', 1)})) AS produtividade_index
        FROM active WHERE mes >= DATE '2000-03-01' GROUP BY 1, 2"""),
    "admissions_cohort": (_COHORTS, "SELECT * FROM adm"),
    "departures_by_area": (_COHORTS, "SELECT * FROM dep"),
    "cohort_join": (_COHORTS, """SELECT competencia, area, coalesce(admissoes, 0) AS admissoes, engajamento_medio,
        salario_medio, performance_medio, coalesce(desligamentos, 0) AS desligamentos,
        coalesce(voluntarios, 0) AS voluntarios FROM adm FULL JOIN dep USING (competencia, area)"""),
    "cohort_join_strict": (_COHORTS, """SELECT competencia, area, admissoes,
        coalesce(engajamento_medio, 0) AS engajamento_medio, coalesce(salario_medio, 0) AS salario_medio,
        coalesce(performance_medio, 0) AS performance_medio, coalesce(desligamentos, 0) AS desligamentos,
        coalesce(voluntarios, 0) AS voluntarios FROM adm LEFT JOIN dep USING (competencia, area)"""),
    "area_risk_proxy": (SILVER, f"""
        SELECT *, (10 - engajamento_medio) * 0.7 + coalesce(engajamento_std, 0) * 0.3 AS risco_proxy
        FROM (SELECT area, count(matricula) AS headcount, {_mean('engajamento_score_base')} AS engajamento_medio,
                {_mean('salario_mensal')} AS salario_medio, {_mean('performance_score')} AS performance_medio,
                stddev_samp(engajamento_score_base) AS engajamento_std
              FROM silver WHERE status = 'Ativo' GROUP BY 1)"""),
    "nine_box": (SILVER, f"""SELECT {_BOX}, area, count(*) AS headcount,
        {_mean('engajamento_score_base')} AS engajamento_medio, {_mean('salario_mensal')} AS salario_medio
        FROM silver WHERE status = 'Ativo' GROUP BY 1, 2, 3"""),
    "nine_box_view": (SCD, """SELECT a.area, v.senioridade,
        1 + CAST(v.senioridade = 'Sênior/Especialista' AS INT)
          + 2 * CAST(v.senioridade = 'Liderança' AND v.salario_mensal >= 10000 AS INT) AS perf_box,
        1 + CAST(v.idade BETWEEN 18 AND 54 AS INT) + CAST(v.idade BETWEEN 25 AND 44 AS INT) AS pot_box,
        count(*) AS headcount
        FROM versions v JOIN dim_area a USING (area) WHERE v.is_current GROUP BY ALL"""),
    "root_cause": (CAUSES, "SELECT * FROM causes"),
    "action_plan": (CAUSES, f"""SELECT 'PA' || lpad(CAST(i + 1 AS VARCHAR), 3, '0') AS id,
        causa_raiz_desc AS causa_raiz, area_predominante AS area_foco,
        coalesce(action, 'Plano de ação a definir junto à área') AS acao_proposta,
        CASE WHEN i < 4 THEN 30 WHEN i < 7 THEN 60 ELSE 90 END AS horizonte_dias,
        CASE WHEN i < 4 THEN 'Alta' WHEN i < 7 THEN 'Média' ELSE 'Baixa' END AS prioridade,
        CASE i % {len(ACTION_OWNERS)} {_OWNER_CASE} END AS responsavel
        FROM (SELECT *, row_number() OVER (ORDER BY total_desligamentos DESC, causa_raiz_desc) - 1 AS i FROM causes)
        LEFT JOIN actions ON reason = causa_raiz_desc WHERE i < 10"""),
    "action_details": (CAUSES, f"""SELECT 'PA' || lpad(CAST(i + 1 AS VARCHAR), 3, '0') AS plano_id,
        coalesce(action, 'Plano de ação a definir junto à área') AS what,
        CAST(pct_do_total_voluntario AS VARCHAR) || '% dos pedidos de saída: ' || causa_raiz_desc || ' (mais em '
          || area_predominante || ')' AS why,
        CASE i % {len(ACTION_OWNERS)} {_OWNER_CASE} END AS who,
        area_predominante AS "where", 'D+' || CASE WHEN i < 4 THEN '30' WHEN i < 7 THEN '60' ELSE '90' END AS "when",
        'Plano por causa: ' || causa_raiz_desc AS how
        FROM (SELECT *, row_number() OVER (ORDER BY total_desligamentos DESC, causa_raiz_desc) - 1 AS i FROM causes)
        LEFT JOIN actions ON reason = causa_raiz_desc WHERE i < 10"""),
    "improvement_cycles": (CAUSES, """SELECT causa_raiz_desc AS causa_raiz,
        'Causa: ' || causa_raiz_desc || ' (' || CAST(pct_do_total_voluntario AS VARCHAR) || '%)' AS plan,
        'Área: ' || area_predominante AS "do",
        'Indicador: ' || CAST(pct_do_total_voluntario AS VARCHAR) || '% por ' || causa_raiz_desc AS "check",
        'Decidir em ' || area_predominante AS act
        FROM causes ORDER BY total_desligamentos DESC, causa_raiz_desc LIMIT 5"""),
    "kpi_cover": (SERIES_CTE, """SELECT *, turnover_ltm_pct <= 18 AS turnover_na_meta, enps_atual >= 50 AS enps_na_meta
        FROM (SELECT competencia, headcount_total AS headcount_atual,
          round((SELECT sum(desligamentos) FROM serie WHERE competencia > '2000-08')
            / greatest(CAST((SELECT headcount_total FROM serie WHERE competencia = '2000-08') AS DOUBLE), 1) * 100, 1)
            AS turnover_ltm_pct,
          enps AS enps_atual, produtividade_index AS produtividade_atual, custo_folha_total AS custo_folha_atual
        FROM serie WHERE competencia = '2001-08')"""),
    "monthly_kpis": (SERIES_CTE, """SELECT competencia, headcount_total AS headcount_ativo, turnover_mensal_pct,
        engajamento_medio, enps FROM serie WHERE competencia = '2001-07'"""),
    "dimension_members": (SILVER, """SELECT DISTINCT 'area' AS dimension, area AS member FROM silver
        UNION ALL SELECT DISTINCT 'senioridade', senioridade FROM silver
        UNION ALL SELECT DISTINCT 'genero', genero FROM silver"""),
    "workforce_plan": (DIMS, _plan(
        "2001-09-01", "SELECT area, count(*) AS hc FROM silver WHERE status = 'Ativo' GROUP BY 1")),
    "plan_gap": (DIMS, f"""
        SELECT p.*, hc AS headcount_projetado, hc - headcount_planejado AS gap
        FROM ({_plan("2001-03-01", f'''SELECT area, count(*) AS hc FROM silver WHERE data_admissao <= DATE '{PLAN_DATE}'
          AND (data_desligamento IS NULL OR data_desligamento > DATE '{PLAN_DATE}') GROUP BY 1''')}) p
        LEFT JOIN (SELECT competencia, area, count(*) AS hc FROM active GROUP BY 1, 2) USING (competencia, area)"""),
    "dim_date": (SILVER, f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_data, CAST(d AS DATE) AS data_completa, year(d) AS ano,
          CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre, quarter(d) AS trimestre, month(d) AS mes,
          CASE month(d) {_NAME_CASE} END AS nome_mes, week(d) AS semana_ano, day(d) AS dia_mes,
          dayofweek(d) + 1 AS dia_semana, CASE dayofweek(d) {_DAY_CASE} END AS nome_dia_semana,
          dayofweek(d) IN (0, 6) AS e_fim_de_semana, FALSE AS e_feriado_nacional,
          strftime(d, '%Y-%m') AS competencia
        FROM generate_series(
          (SELECT least(min(data_admissao), min(data_desligamento)) FROM silver),
          (SELECT greatest(max(data_admissao), max(data_desligamento)) FROM silver), INTERVAL 1 DAY) AS g(d)"""),
    "dim_area": (DIMS, """SELECT sk_area, a.area, classificacao_risco, count(matricula) AS headcount
        FROM dim_area a LEFT JOIN (SELECT * FROM silver WHERE status = 'Ativo') s ON a.area = s.area
        GROUP BY 1, 2, 3"""),
    "dim_motivo": (DIMS, """SELECT sk_motivo, motivo, categoria_rca, e_retencao_possivel,
        count(matricula) AS desligamentos FROM dim_reason
        LEFT JOIN (SELECT * FROM silver WHERE data_desligamento IS NOT NULL) ON motivo = motivo_desligamento
        GROUP BY 1, 2, 3, 4"""),
    "scd2_employee": (SCD, "SELECT * FROM versions"),
    "dim_employee": (SCD, "SELECT * FROM employees"),
    "dim_employee_incremental": (SCD, "SELECT * FROM employees"),
    "fact_departure": (SCD, "SELECT * FROM fact"),
    "fact_headcount": (FACT_HC, "SELECT * FROM fact_hc"),
    "turnover_ltm": (FACT_HC, """SELECT area, classificacao_risco, sum(desligamentos) AS total_desligamentos,
        sum(desligamentos_vol) AS desligamentos_voluntarios, avg(headcount) AS headcount_medio,
        round(sum(desligamentos) / nullif(avg(headcount), 0) * 100, 1) AS turnover_ltm_pct,
        round(sum(desligamentos) * count(DISTINCT competencia) / CAST(nullif(sum(headcount), 0) AS DOUBLE) * 100, 1)
          AS turnover_ltm_pct_area,
        round(sum(desligamentos_vol) / CAST(nullif(sum(desligamentos), 0) AS DOUBLE) * 100, 1) AS pct_voluntario
        FROM fact_hc JOIN dim_area USING (sk_area) WHERE competencia BETWEEN '2000-08' AND '2001-08' GROUP BY 1, 2"""),
    "turnover_cost_ltm": (SCD, f"""SELECT area, sum(custo_estimado_turnover) AS custo_total_turnover,
        count(*) AS total_desligamentos, avg(custo_estimado_turnover) AS custo_medio_por_desligamento
        FROM fact JOIN dim_area USING (sk_area)
        WHERE sk_data_deslig BETWEEN 20000801 AND {REFERENCE_DATE.replace('-', '')} GROUP BY 1"""),
    "departure_careers": (CAREERS, "SELECT * FROM careers"),
    "departure_profiles": (CAREERS, """SELECT senioridade_inicial, senioridade_na_saida, categoria_rca,
        count(*) AS desligamentos, count(dias_desde_mudanca) AS com_mudanca,
        avg(dias_desde_mudanca) AS dias_desde_mudanca_medio, count(*) FILTER (e_early_turnover) AS early_turnover,
        sum(custo_estimado_turnover) AS custo_total_turnover
        FROM careers LEFT JOIN dim_reason USING (sk_motivo) GROUP BY 1, 2, 3"""),
    "star_constraints": (STAR, "\nUNION ALL\n".join([
        _not_key("pk_dim_colaborador", "employees", "sk_colaborador"),
        _not_key("pk_fct_desligamento", "fact", "sk_desligamento"),
        _no_parent("fk_colaborador", "fact", "sk_colaborador", "employees", "sk_colaborador"),
        _no_parent("fk_area", "fact", "sk_area", "dim_area", "sk_area"),
        _no_parent("fk_motivo", "fact", "sk_motivo", "dim_reason", "sk_motivo"),
        _no_parent("fk_data_deslig", "fact", "sk_data_deslig", "days", "sk_data"),
        _no_parent("fk_data_admissao", "fact", "sk_data_admissao", "days", "sk_data"),
        _no_parent("fk_colaborador_area", "employees", "sk_area", "dim_area", "sk_area"),
        _no_parent("fk_headcount_area", "fact_hc", "sk_area", "dim_area", "sk_area"),
        _not_key("pk_dim_data", "days", "sk_data"),
        _not_key("pk_dim_area", "dim_area", "sk_area"),
        _not_key("pk_dim_motivo", "dim_reason", "sk_motivo"),
        _not_key("pk_fct_headcount", "fact_hc", "competencia, sk_area, senioridade"),
        _nulls("not_null_dim_colaborador", "employees", "nk_matricula sk_area data_inicio_vigencia"),
        _nulls("not_null_fct_desligamento", "fact",
               "sk_colaborador sk_area sk_motivo sk_data_deslig sk_data_admissao"),
        _nulls("not_null_fct_headcount", "fact_hc", "sk_area competencia senioridade headcount")])),
    "funnel": (FUNNEL, f"SELECT *, {_RATES} FROM counted"),
    "funnel_by_cohort": (_STEPS, f"""SELECT *, {_RATES} FROM (
        SELECT strftime(t0, '%Y-%m') AS competencia, c_mktsegment AS segmento,
          {', '.join(f'count(t{k}) AS {s}' for k, s in enumerate(STAGES))},
          avg(date_sub('second', t0, t{len(STAGES) - 1})) / 86400 AS mean_days
        FROM s{len(STAGES) - 1} LEFT JOIN customer ON c_custkey = user_id GROUP BY 1, 2)"""),
    "stratified_split": (_LABELS, """SELECT matricula, label,
        row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || matricula), matricula)
          <= 75 * count(*) OVER (PARTITION BY label) // 100 AS in_train FROM labelled"""),
    "encode_city": (_FOLDED + """,
cells AS (SELECT cidade, fold, sum(label) AS s, count(*) AS n FROM people GROUP BY ALL),
priors AS (SELECT f.fold, sum(c.s) / sum(c.n) AS prior FROM (SELECT DISTINCT fold FROM people) f
           JOIN cells c ON c.fold <> f.fold GROUP BY 1)""", """SELECT p.matricula, p.cidade,
          (coalesce(sum(c.s), 0) + 20 * any_value(prior)) / (coalesce(sum(c.n), 0) + 20) AS cidade_mean
        FROM people p JOIN priors USING (fold) LEFT JOIN cells c ON c.cidade IS NOT DISTINCT FROM p.cidade
          AND c.fold <> p.fold GROUP BY 1, 2"""),
    "city_means": (_FOLDED, """SELECT cidade, FALSE AS other,
          (sum(label) + 20 * (SELECT avg(label) FROM people)) / (count(*) + 20) AS mean FROM people GROUP BY 1
        UNION ALL SELECT NULL, TRUE, avg(label) FROM people"""),
    "rule_auc": (_AUC, "SELECT * FROM measured"),
    "quality_sla_model": (_AUC, _SLA + """ UNION ALL SELECT 'model_auc', roc_auc, 0.65, 0.6,
        CASE WHEN roc_auc < 0.6 THEN 'alert' WHEN roc_auc >= 0.65 THEN 'ok' ELSE 'warn' END FROM measured"""),
    "attrition_labels": (_LABELS, "SELECT * FROM labelled"),
    "base_rate": (_LABELS, """SELECT count(*) AS eligible, sum(label) AS leavers,
        round(sum(label) / CAST(count(*) AS DOUBLE) * 100, 1) AS taxa_attrition_base FROM labelled"""),
    "risk_band": (SILVER, """SELECT *, CASE WHEN score > 0 AND score <= 0.15 THEN 'Baixo'
        WHEN score > 0.15 AND score <= 0.35 THEN 'Médio' WHEN score > 0.35 AND score <= 1 THEN 'Alto' END AS faixa_risco
        FROM (SELECT matricula, round((10 - engajamento_score_base) / 20, 4) AS score FROM silver)"""),
    "rule_risk_by_area": (_RULED, """SELECT area, count(*) AS headcount,
        round(CAST(sum(CAST(score AS DECIMAL(18,12))) AS DOUBLE) / count(score), 3) AS risco_medio,
        count(*) FILTER (faixa_risco = 'Alto') AS qtd_alto_risco FROM ruled GROUP BY 1"""),
    "rule_top_risk": (_RULED, """SELECT *, score AS risco_attrition_score, tempo_casa_meses AS tempo_casa_meses_ref
        FROM ruled ORDER BY score DESC, matricula LIMIT 20"""),
    "rule_band_counts": (_RULED, "SELECT faixa_risco, count(*) AS rows FROM ruled GROUP BY 1"),
    "person_bands": (SILVER, """SELECT matricula,
        CASE WHEN idade BETWEEN 18 AND 24 THEN '18-24' WHEN idade BETWEEN 25 AND 34 THEN '25-34'
          WHEN idade BETWEEN 35 AND 44 THEN '35-44' WHEN idade BETWEEN 45 AND 54 THEN '45-54'
          WHEN idade >= 55 THEN '55+' END AS faixa_etaria,
        CASE WHEN salario_mensal <= 5000 THEN 'Até 5k' WHEN salario_mensal < 10000 THEN '5-10k'
          WHEN salario_mensal < 20000 THEN '10-20k' WHEN salario_mensal >= 20000 THEN '20k+' END AS faixa_salarial
        FROM silver"""),
    "retrain_days": (SILVER, """SELECT DISTINCT strftime(data_admissao, '%Y-%m') AS competencia, data_admissao AS dia
        FROM silver WHERE dayofweek(data_admissao) = 1 AND day(data_admissao) <= 7"""),
    "csv_roundtrip": (NAMES, "SELECT * FROM raw"),
    "silver_partitions": (SILVER, "SELECT area, count(*) AS rows FROM silver GROUP BY 1"),
    "incremental_ingest": (_exports(EXPORTS[:2]), "SELECT * FROM cleaned"),
    "refreshed_exports": (_exports(EXPORTS[:2]), """SELECT export_date, senioridade, count(*) AS headcount,
        sum(CAST(salario_mensal AS DECIMAL(18,2))) AS folha FROM cleaned GROUP BY 1, 2"""),
    "intake_quarantine": (_QUARANTINE, """SELECT * FROM (
        SELECT export_date, count(*) FILTER (NOT bad) AS rows, count(*) FILTER (bad) AS malformed,
          count(*) FILTER (bad_key) AS bad_keys FROM landed GROUP BY 1)
        JOIN (SELECT export_date, count(*) AS silver_rows, sum(CAST(salario_mensal AS DECIMAL(18,2))) AS folha
              FROM cleaned GROUP BY 1) USING (export_date)"""),
    "late_export": (_exports((EXPORTS[2],)), "SELECT * FROM cleaned"),
}


def all_oracles() -> dict[str, str]:
    return {name: shape_sql(ctes, query, COLUMNS[name]) for name, (ctes, query) in ORACLES.items()}
