"""The same queries in DuckDB SQL over the test tables."""

from __future__ import annotations

_EVENTS = r"""
WITH raw AS (
  SELECT event_id AS tx_id, ts, user_id AS doc_id, event_type,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
led AS (
  SELECT tx_id, ts, doc_id, amount,
    CASE event_type WHEN 'purchase' THEN 'Jugada' WHEN 'click' THEN 'Carga saldo desde MODO'
      WHEN 'view' THEN 'Carga saldo desde TJ' WHEN 'signup' THEN 'Bonificación'
      ELSE CASE WHEN k % 2 = 0 THEN 'Retiro' ELSE 'Premio' END END AS movement_type,
    CASE event_type WHEN 'purchase' THEN 'Jugada - ' || CASE k % 4 WHEN 0 THEN 'Tombo Express'
        WHEN 1 THEN 'Tómbola' WHEN 2 THEN 'Quini 6' ELSE 'Loto Plus' END
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'Bono registro' ELSE 'Bono depósito' END
      ELSE event_type END AS description
  FROM raw)"""

_ORDERS = r"""
WITH led AS (
  SELECT o_orderkey AS tx_id, o_orderdate AS ts, o_custkey AS doc_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'Jugada' WHEN 'O' THEN 'Carga saldo desde MODO'
      WHEN 'P' THEN 'Carga saldo desde TJ' END AS movement_type,
    CASE o_orderstatus WHEN 'F' THEN 'Jugada - ' || o_orderpriority ELSE o_orderstatus END
      AS description
  FROM orders)"""

_STRICT = r"regexp_matches(lower(strip_accents(movement_type)), '^carga\s+saldo\s+desde\s*(?:modo|tj)\b')"
_BROAD = r"regexp_matches(movement_type, 'carga|dep[oó]sito', 'i')"
_EXTENDED = r"""CASE
    WHEN contains(d, 'modo') OR contains(t, 'modo') THEN 'MODO'
    WHEN contains(d, 'tj') OR contains(d, 'tarjeta') OR contains(t, 'tj') OR contains(t, 'tarjeta') THEN 'Retail'
    WHEN contains(d, 'agencia') OR contains(d, 'pos') OR contains(d, 'caja') THEN 'Retail'
    ELSE 'Otro' END"""
_BINARY = "CASE WHEN contains(d, 'modo') THEN 'MODO' ELSE 'Retail' END"


def _classified(load: str = _STRICT, channel: str = _EXTENDED) -> str:
    return rf""",
folded AS (
  SELECT *, lower(strip_accents(description)) AS d, lower(strip_accents(movement_type)) AS t FROM led),
cls AS (
  SELECT *, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month,
    regexp_matches(movement_type, 'apuesta|jugada', 'i') AS is_bet,
    {load} AS is_load,
    regexp_matches(movement_type, 'retiro|transferencia salida', 'i') AS is_withdrawal,
    regexp_matches(movement_type, 'premio', 'i') AS is_prize,
    contains(t, 'bonific') AS is_bonus,
    {channel} AS channel,
    trim(regexp_replace(description, 'jugada\s*-\s*', '', 'gi')) AS game
  FROM folded),
bets AS (SELECT *, lower(strip_accents(game)) AS game_norm FROM cls WHERE is_bet),
loads AS (SELECT * FROM cls WHERE is_load),
modo AS (SELECT * FROM loads WHERE channel = 'MODO')
"""


def _users(start: str) -> str:
    return f""",
users AS (
  SELECT c_custkey AS user_id, c_name AS username, lower(c_name) || '@example.com' AS email,
    CAST(DATE '{start}' + CAST(c_custkey * 9 % 1400 AS INTEGER) AS TIMESTAMP) AS signup_ts
  FROM customer)
"""


E = _EVENTS + _classified()
R = _ORDERS + _classified()
EU = E + _users("2020-06-01")
RU = R + _users("1994-06-01")

_DAYS = "day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
_TIMES = "ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'"
_SUM = "CAST(coalesce(sum(amount), 0) AS DOUBLE)"


def _first_values(source: str, time_name: str) -> str:
    return f"""
SELECT doc_id AS "Documento", min(ts) AS "{time_name}",
  arg_min(tx_id, (ts, tx_id)) FILTER (WHERE tx_id IS NOT NULL) AS "Nro_Transaccion",
  arg_min(movement_type, (ts, tx_id)) FILTER (WHERE movement_type IS NOT NULL) AS "Tipo_Mov",
  arg_min(description, (ts, tx_id)) FILTER (WHERE description IS NOT NULL) AS "Movimiento",
  CAST(arg_min(amount, (ts, tx_id)) FILTER (WHERE amount IS NOT NULL) AS DOUBLE) AS "Importe"
FROM {source} WHERE doc_id IS NOT NULL GROUP BY doc_id"""


_RETENTION = """,
base AS (SELECT doc_id, min(ts) AS cut FROM modo GROUP BY doc_id),
firsts AS (SELECT doc_id, min(ts) AS first_ts FROM cls GROUP BY doc_id),
joined AS (
  SELECT b.doc_id, b.cut, f.first_ts, x.ts FROM base b
  JOIN firsts f USING (doc_id) LEFT JOIN bets x ON x.doc_id = b.doc_id)
SELECT doc_id AS "Documento", cut AS "Fecha_Corte", first_ts AS "Fecha_PrimerMov",
  coalesce(cut = first_ts, false) AS "Es_Nuevo",
  coalesce(bool_or(ts > cut), false) AS "Jugo_Posterior",
  coalesce(bool_or(ts > cut AND ts <= cut + INTERVAL 1 DAY), false) AS "Jugo_Dia_Sig",
  coalesce(bool_or(ts > cut AND ts <= cut + INTERVAL 30 DAY), false) AS "Jugo_Mes_Sig"
FROM joined GROUP BY doc_id, cut, first_ts"""

_FIRST_EVENT = """,
fb AS (SELECT doc_id, min(ts) AS first_bet FROM bets GROUP BY doc_id)
SELECT doc_id AS "Documento", first_bet AS "Fecha_Primera_Apuesta",
  (SELECT min(l.ts) FROM loads l WHERE l.doc_id = fb.doc_id AND l.ts > fb.first_bet) AS "Fecha_Recarga_Posterior",
  (SELECT min(b.ts) FROM bets b WHERE b.doc_id = fb.doc_id AND b.ts > fb.first_bet) AS "Fecha_Segunda_Apuesta"
FROM fb"""

_BONUS = """,
bonuses AS (
  SELECT tx_id, doc_id, ts, day, amount,
    CASE WHEN regexp_matches(t || ' ' || d, 'registro|alta|bienvenida') THEN 'Registro' ELSE 'Depósito' END AS kind
  FROM cls WHERE is_bonus AND amount IS NOT NULL),
later AS (
  SELECT b.tx_id, b.amount, x.ts,
    sum(x.amount) OVER (PARTITION BY b.tx_id ORDER BY x.ts, x.tx_id ROWS UNBOUNDED PRECEDING) AS staked
  FROM bonuses b JOIN bets x ON x.doc_id = b.doc_id AND x.ts > b.ts),
played AS (
  SELECT tx_id, min(ts) AS first_bet, min(ts) FILTER (WHERE staked >= amount) AS spent
  FROM later GROUP BY tx_id),
last_loads AS (SELECT doc_id, max(ts) AS last_load FROM loads GROUP BY doc_id),
detail AS (
  SELECT b.*, p.first_bet, p.spent, coalesce(l.last_load > p.spent, false) AS reloaded
  FROM bonuses b LEFT JOIN played p USING (tx_id) LEFT JOIN last_loads l USING (doc_id)),
bkpis AS (
  SELECT day, count(*) AS granted, sum(amount) AS amount, count(first_bet) AS played, count(spent) AS spent,
    count(*) FILTER (WHERE reloaded) AS reloaded, count(*) FILTER (WHERE kind = 'Registro') AS reg,
    count(*) FILTER (WHERE kind = 'Depósito') AS dep
  FROM detail GROUP BY day),
rates AS (
  SELECT CAST(coalesce(sum(granted), 0) AS BIGINT) AS granted, CAST(coalesce(sum(played), 0) AS BIGINT) AS played,
    CAST(coalesce(sum(spent), 0) AS BIGINT) AS spent, CAST(coalesce(sum(reloaded), 0) AS BIGINT) AS reloaded,
    CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount
  FROM bkpis WHERE """ + _DAYS + """)
"""


def _pct(column: str) -> str:
    return f"coalesce(CAST({column} AS DOUBLE) / nullif(granted, 0) * 100, 0.0)"


def _rows(label: str, value: str, source: str, entries: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{text}' AS \"{label}\", {expr} AS \"{value}\" FROM {source}" for text, expr in entries
    )


_DAY_GAME = """
SELECT {key} AS "{name}", game AS "Juego", count(amount) AS "{n}", count(DISTINCT doc_id) AS "{u}",
  """ + _SUM + """ AS "{s}" FROM bets GROUP BY 1, 2"""


def _dedup(direction: str) -> str:
    order = ", ".join(
        f"{c} {direction} NULLS LAST"
        for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    )
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


_PATTERNS = r"""(VALUES ('Tombo_Express', 'tombo express'), ('Tombola', 't(?:o|ó)mbola'),
  ('Quini6', 'quini\s*6'), ('Loto_Plus', 'loto(?:\s*plus)?')) p(name, pattern)"""
_PLAYERS = f"""
SELECT name AS "Juego", doc_id AS "Documento", count(amount) AS "Bets", {_SUM} AS "Gastado"
FROM bets JOIN {_PATTERNS} ON regexp_matches(game_norm, pattern)
GROUP BY 1, 2"""


def amount_pivot() -> str:
    cell = "CAST(coalesce(sum(amount) FILTER (WHERE channel = '{c}'), 0) AS DOUBLE)"
    cells = ", ".join(f'{cell.format(c=c)} AS "{c}"' for c in ("MODO", "Retail"))
    return f'SELECT day AS "Fecha_Dia", {cells} FROM loads GROUP BY 1'


def oracles() -> dict[str, str]:
    from ledgerlens.plans import files, streams

    def pivot(cell: str) -> str:
        cells = ", ".join(f'{cell.format(c=c)} AS "{c}"' for c in ("MODO", "Retail"))
        return f'SELECT day AS "Fecha_Dia", {cells} FROM loads GROUP BY 1'

    amount_cell = "CAST(coalesce(sum(amount) FILTER (WHERE channel = '{c}'), 0) AS DOUBLE)"
    count_cell = "count(amount) FILTER (WHERE channel = '{c}')"
    mean_cell = (
        "CAST(sum(amount) FILTER (WHERE channel = '{c}') AS DOUBLE)"
        " / nullif(count(amount) FILTER (WHERE channel = '{c}'), 0)"
    )
    mean_columns = ", ".join(
        f'round(coalesce(avg("{c}"), 0.0), 6) AS "Promedio_Diario_{c}"' for c in ("MODO", "Retail")
    )
    launch, start = "TIMESTAMP '2024-01-10'", "TIMESTAMP '2024-01-15'"
    by_channel = f"""SELECT channel AS "Canal", count(amount) AS "Recargas",
      count(DISTINCT doc_id) AS "Usuarios_Unicos", {_SUM} AS "Monto" FROM loads GROUP BY 1"""
    rates_columns = """granted AS "Bonos_Otorgados", played AS "Jugaron_PostBono", spent AS "Agotaron_Bono",
      reloaded AS "Recargaron_Luego", amount AS "Monto_Bonos" """
    return {
        "client_month_game": R + f"""SELECT doc_id AS "Documento", month AS "AñoMes", game AS "Juego",
          count(amount) AS "Bets", {_SUM} AS "Gastado" FROM bets GROUP BY 1, 2, 3""",
        "top_games_total": R + f"""SELECT game AS "Juego", count(amount) AS "Bets_Totales",
          count(DISTINCT doc_id) AS "Jugadores_Unicos", {_SUM} AS "Gastado" FROM bets GROUP BY 1""",
        "top_games_month": R + _DAY_GAME.format(
            key="month", name="AñoMes", n="Bets_Mes", u="Jugadores_Mes", s="Gastado_Mes"),
        "game_player_summary": E + _PLAYERS,
        "loads_daily_channel": E + f"""SELECT day AS "Fecha_Dia", channel AS "Canal", count(amount) AS "Recargas",
          {_SUM} AS "Monto", count(DISTINCT doc_id) AS "Usuarios_Unicos" FROM loads GROUP BY 1, 2""",
        "loads_daily_amount_pivot": E + pivot(amount_cell),
        "loads_daily_count_pivot": E + pivot(count_cell),
        "avg_deposit_daily": E + pivot(mean_cell),
        "channel_daily": E + f"""SELECT day AS "Fecha_Dia", count(amount) AS "Recargas_MODO",
          {_SUM} AS "Monto_MODO", count(DISTINCT doc_id) AS "Usuarios_Unicos" FROM modo GROUP BY 1""",
        "withdrawals_daily": E + f"""SELECT day AS "Fecha_Dia", count(amount) AS "Retiros",
          {_SUM} AS "Monto_Retirado", count(DISTINCT doc_id) AS "Clientes_Unicos"
          FROM cls WHERE is_withdrawal GROUP BY 1""",
        "winners": E + f"""SELECT doc_id AS "Documento", count(amount) AS "Premios_Cobrados",
          {_SUM} AS "Monto_Premios" FROM cls WHERE is_prize GROUP BY 1""",
        "game_day_detail": E + _DAY_GAME.format(
            key="day", name="Fecha_Dia", n="Bets", u="Usuarios_Unicos_Dia", s="Gastado_Dia"),
        "weekday_totals": E + """SELECT CASE isodow(ts) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes'
          WHEN 3 THEN 'Miércoles' WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado'
          ELSE 'Domingo' END AS "Dia_Sem", count(amount) AS "Bets",
          count(DISTINCT doc_id) AS "Usuarios_Unicos" FROM bets GROUP BY 1""",
        "first_movement": E + _first_values("cls", "Fecha_PrimerMov"),
        "first_channel_load": E + _first_values("modo", "Fecha_Corte"),
        "channel_retention": E + _RETENTION,
        "channel_retention_orders": R + _RETENTION,
        "new_channel_users": E + """, a AS (SELECT doc_id, min(ts) AS first_ts FROM cls GROUP BY 1),
          b AS (SELECT doc_id, min(ts) AS cut FROM modo GROUP BY 1)
          SELECT count(*) AS "Nuevos_MODO" FROM a JOIN b USING (doc_id) WHERE first_ts = cut""",
        "monthly_growth": R + """, firsts AS (SELECT doc_id, strftime(min(ts), '%Y-%m') AS month FROM cls GROUP BY 1),
          news AS (SELECT month, count(*) AS n FROM firsts GROUP BY 1),
          act AS (SELECT month, count(DISTINCT doc_id) AS a FROM bets GROUP BY 1)
          SELECT month AS "AñoMes", n AS "Nuevos", CAST(sum(n) OVER (ORDER BY month) AS BIGINT) AS "Acumulado",
            a AS "Jugadores_Activos_Mes" FROM news LEFT JOIN act USING (month)""",
        "monthly_active": R + """SELECT month AS "AñoMes", count(DISTINCT doc_id) AS "Jugadores_Activos_Mes"
          FROM bets GROUP BY 1""",
        "milestone_counts": E + _rows("Concepto", "Valor", "(SELECT 1)", [
            ("Nuevos >= 2024-01-10 (cualquier mov.)",
             f"(SELECT count(*) FROM (SELECT doc_id, min(ts) m FROM cls GROUP BY 1) WHERE m >= {launch})"),
            ("Jugadores >= 2024-01-10 (cualquier apuesta)",
             f"(SELECT count(DISTINCT doc_id) FROM bets WHERE ts >= {launch})"),
            ("Apostaron Quini/Loto >= 2024-01-10",
             f"(SELECT count(DISTINCT doc_id) FROM bets WHERE ts >= {launch}"
             r" AND regexp_matches(game_norm, 'quini\s*6|loto(?:\s*plus)?'))"),
            ("Recargaron MODO >= 2024-01-15", f"(SELECT count(DISTINCT doc_id) FROM modo WHERE ts >= {start})"),
            ("Jugadores >= 2024-01-15 (cualquier apuesta)",
             f"(SELECT count(DISTINCT doc_id) FROM bets WHERE ts >= {start})"),
            ("Recargaron MODO y jugaron >= 2024-01-15",
             f"(SELECT count(*) FROM (SELECT doc_id FROM modo WHERE ts >= {start}"
             f" INTERSECT SELECT doc_id FROM bets WHERE ts >= {start}))"),
        ]),
        "before_after": E + " UNION ALL ".join(
            f"""SELECT '{name} 15/01/2024' AS "Periodo",
            (SELECT {_SUM} FROM loads WHERE ts {op} {start}) AS "Depositos_$",
            (SELECT {_SUM} FROM bets WHERE ts {op} {start}) AS "Recaudacion_$" """
            for name, op in (("Before", "<"), ("After", ">="))),
        "kpi_summary": E + _rows("KPI", "Valor", "(SELECT 1)", [
            ("Promedio depósito $", "(SELECT CAST(sum(amount) AS DOUBLE) / count(amount) FROM loads)"),
            ("Usuarios únicos (cualquier mov.)", "(SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) FROM cls)"),
            ("Usuarios únicos apostadores", "(SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) FROM bets)"),
            ("Usuarios únicos que recargaron", "(SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) FROM loads)"),
            ("Recargas - MODO", "(SELECT CAST(count(amount) AS DOUBLE) FROM modo)"),
            ("Recargas - Retail", "(SELECT CAST(count(amount) AS DOUBLE) FROM loads WHERE channel = 'Retail')"),
            ("Monto MODO $", f"(SELECT {_SUM} FROM modo)"),
            ("Monto Retail $", f"(SELECT {_SUM} FROM loads WHERE channel = 'Retail')"),
        ]),
        "loads_by_channel": E + by_channel,
        "activity_kpis": EU + """, k AS (SELECT (SELECT CAST(count(*) AS DOUBLE) FROM users) AS r,
          (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) FROM cls) AS a) """ + _rows("KPI", "Valor", "k", [
            ("Total Usuarios Registrados", "r"),
            ("Usuarios Activos (con mov.)", "a"),
            ("Usuarios Inactivos (sin mov.)", "r - a"),
            ("Tasa de Actividad (%)", "a / r * 100"),
        ]),
        "bets_per_user": E + f"""SELECT doc_id AS "Documento", count(amount) AS "Bets_Total",
          {_SUM} AS "Gastado_Total" FROM bets GROUP BY 1""",
        "contact_top10": EU + f"""SELECT doc_id AS "Documento", count(amount) AS "Bets_Total",
          {_SUM} AS "Gastado_Total", user_id AS "DNI", username AS "Usuario", email AS "Correo"
          FROM bets JOIN users ON doc_id = user_id GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10""",
        "game_top10_users": EU + f""", players AS ({_PLAYERS})
          SELECT "Juego", "Documento", "Bets", "Gastado", user_id AS "DNI", username AS "Usuario",
            email AS "Correo" FROM players JOIN users ON "Documento" = user_id
          QUALIFY row_number() OVER (PARTITION BY "Juego" ORDER BY "Gastado" DESC, "Documento") <= 10""",
        "new_users_since": EU + f"""SELECT user_id AS "Documento", signup_ts AS "Fecha_Alta",
          username AS "Usuario", email AS "Correo" FROM users WHERE signup_ts >= {start}""",
        "new_users_total": EU + f"""SELECT 'Total Nuevos Usuarios desde 15/01/2024' AS "KPI",
          count(*) AS "Valor" FROM users WHERE signup_ts >= {start}""",
        "reactivated_users": RU + """, after AS (
            SELECT doc_id, min(ts) AS ts FROM modo WHERE ts >= TIMESTAMP '1998-07-07' GROUP BY 1)
          SELECT user_id AS "Documento", signup_ts AS "Fecha_Alta", username AS "Usuario", email AS "Correo",
            ts AS "Fecha" FROM users JOIN after ON doc_id = user_id
          WHERE year(signup_ts) BETWEEN 1994 AND 1997
            AND user_id NOT IN (SELECT doc_id FROM modo WHERE ts < TIMESTAMP '1998-07-07')""",
        "cohort_retention": RU + """, fb AS (SELECT doc_id, min(ts) AS first_bet FROM bets GROUP BY 1),
          funnel AS (SELECT strftime(signup_ts, '%Y-%m') AS cohort, user_id, first_bet FROM users JOIN fb ON doc_id = user_id),
          ll AS (SELECT DISTINCT l.doc_id FROM loads l JOIN fb USING (doc_id) WHERE l.ts > first_bet),
          bb AS (SELECT DISTINCT b.doc_id FROM bets b JOIN fb USING (doc_id) WHERE b.ts > first_bet),
          c AS (SELECT cohort, count(DISTINCT user_id) AS total, count(*) FILTER (WHERE ll.doc_id IS NOT NULL
            AND bb.doc_id IS NOT NULL) AS kept FROM funnel LEFT JOIN ll ON ll.doc_id = user_id
            LEFT JOIN bb ON bb.doc_id = user_id GROUP BY 1)
          SELECT cohort AS "Cohorte_Mes", total AS "Total_Nuevos_Usuarios", kept AS "Retenidos_30_Dias",
            CAST(kept AS DOUBLE) / total * 100 AS "Tasa_Retencion_30_Dias",
            CAST(NULL AS DOUBLE) AS "Tasa_Retencion_7_Dias" FROM c""",
        "first_event": R + _FIRST_EVENT,
        "first_event_intraday": E + _FIRST_EVENT,
        "revenue_daily": R + f"""SELECT day AS "Fecha_Dia", {_SUM} AS "Recaudacion" FROM bets GROUP BY 1""",
        "bets_month_game": R + """SELECT month AS "AñoMes", game AS "Juego", count(amount) AS "Total_Bets"
          FROM bets GROUP BY 1, 2""",
        "game_evolution": R + """SELECT month AS "AñoMes", game AS "Juego", count(amount) AS "Total_Bets"
          FROM bets WHERE month BETWEEN '1996-02' AND '1998-07' GROUP BY 1, 2""",
        "inactive_users": EU + """SELECT user_id, username, email, signup_ts FROM users
          WHERE user_id NOT IN (SELECT doc_id FROM cls)""",
        "period_kpis": EU + f""", p AS (SELECT
            count(amount) FILTER (WHERE is_load AND channel = 'MODO' AND {_DAYS}) AS mn,
            count(amount) FILTER (WHERE is_load AND channel = 'Retail' AND {_DAYS}) AS rn,
            coalesce(sum(amount) FILTER (WHERE is_load AND channel = 'MODO' AND {_DAYS}), 0) AS ma,
            coalesce(sum(amount) FILTER (WHERE is_load AND channel = 'Retail' AND {_DAYS}), 0) AS ra,
            coalesce(sum(amount) FILTER (WHERE is_bet AND {_DAYS}), 0) AS rev,
            count(DISTINCT doc_id) FILTER (WHERE is_bet AND {_TIMES}
              AND doc_id IN (SELECT user_id FROM users)) AS b FROM cls)
          SELECT coalesce((CAST(ma AS DOUBLE) + CAST(ra AS DOUBLE)) / nullif(mn + rn, 0), 0.0) AS "Promedio_Deposito",
            b AS "Usuarios_Apostadores", mn + rn AS "Usuarios_Recargaron", CAST(rev AS DOUBLE) AS "Recaudacion_Periodo",
            mn AS "Recargas_MODO", rn AS "Recargas_Retail", CAST(ma AS DOUBLE) AS "Monto_MODO",
            CAST(ra AS DOUBLE) AS "Monto_Retail" FROM p""",
        "mean_daily_deposit": E + f""", d AS ({pivot(mean_cell)})
          SELECT {mean_columns}
          FROM d WHERE "Fecha_Dia" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
        "dynamic_top10": EU + f"""SELECT doc_id AS "Documento", username AS "Usuario", email AS "Correo",
          {_SUM} AS "Total_Gastado", count(amount) AS "Total_Apuestas"
          FROM bets JOIN users ON doc_id = user_id WHERE {_TIMES} AND game = 'Tómbola'
          GROUP BY ALL ORDER BY 4 DESC, 1 LIMIT 10""",
        "bonus_detail": E + _BONUS + _users("2020-06-01") + """SELECT tx_id AS "Nro_Transaccion",
          detail.doc_id AS "DNI_NORM", email AS "Email", ts AS "Fecha_Bono", CAST(amount AS DOUBLE) AS "Monto_Bono",
          kind AS "Tipo_Bono", first_bet IS NOT NULL AS "Hizo_Jugada_PostBono", first_bet AS "Fecha_Primera_Jugada",
          spent AS "Fecha_Agote_Bono", reloaded AS "Recargo_despues_Agote"
          FROM detail LEFT JOIN users ON user_id = detail.doc_id""",
        "bonus_daily": E + _BONUS + """SELECT day AS "Fecha_Dia", granted AS "Bonos_Otorgados",
          CAST(amount AS DOUBLE) AS "Monto_Bonos", reg AS "Registro_Cant", dep AS "Deposito_Cant" FROM bkpis""",
        "bonus_kpis": E + _BONUS + """SELECT day AS "Fecha_Dia", granted AS "Bonos_Otorgados",
          CAST(amount AS DOUBLE) AS "Monto_Bonos", played AS "Jugaron_PostBono", spent AS "Agotaron_Bono",
          reloaded AS "Recargaron_Luego", reg AS "Registro_Cant", dep AS "Deposito_Cant" FROM bkpis""",
        "bonus_rates": E + _BONUS + f"""SELECT {rates_columns}, {_pct('played')} AS "Pct_Jugaron",
          {_pct('spent')} AS "Pct_Agotaron", {_pct('reloaded')} AS "Pct_Recargaron" FROM rates""",
        "bonus_funnel": E + _BONUS + _rows("Etapa", "Porcentaje", "rates", [
            ("Jugaron tras bono", _pct("played")), ("Agotaron el bono", _pct("spent")),
            ("Recargaron después", _pct("reloaded"))]),
        "bonus_by_type": E + _BONUS + f"""SELECT day AS "Fecha_Dia", 'Registro' AS "Tipo",
            CAST(reg AS DOUBLE) AS "Cantidad" FROM bkpis WHERE {_DAYS}
          UNION ALL SELECT day, 'Depósito', CAST(dep AS DOUBLE) FROM bkpis WHERE {_DAYS}""",
        "date_bounds": E + """SELECT min(day) AS "Fecha_Min", max(day) AS "Fecha_Max" FROM loads""",
        "game_list": E + """SELECT DISTINCT game AS "Juego" FROM bets""",
        "game_calendar": E + """, top AS (SELECT game FROM bets GROUP BY game ORDER BY count(amount) DESC, game LIMIT 6),
          days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM bets),
          cells AS (SELECT day, game, count(amount) AS n FROM bets GROUP BY 1, 2)
          SELECT days.day AS "Fecha_Dia", top.game AS "Juego", CASE WHEN days.day BETWEEN DATE '2024-01-05'
            AND DATE '2024-01-20' THEN coalesce(n, 0) END AS "Bets"
          FROM days CROSS JOIN top LEFT JOIN cells ON cells.day = days.day AND cells.game = top.game""",
        "ledger_dedup_last": _dedup("DESC"),
        "ledger_dedup_first": _dedup("ASC"),
        "binary_channel": _EVENTS + _classified(_BROAD, _BINARY) + f"""SELECT channel AS "Canal",
          channel AS "Metodo", count(amount) AS "Recargas", {_SUM} AS "Monto",
          count(DISTINCT doc_id) AS "Usuarios_Unicos" FROM loads GROUP BY 1""",
        "broad_loads": _EVENTS + _classified(_BROAD) + by_channel,
        "doc_key_clean": _EVENTS + r""", x AS (SELECT tx_id, 'DNI 00' || doc_id || '.0' AS text FROM led)
          SELECT tx_id, text, TRY_CAST(ltrim(regexp_extract(text, '(\d+)', 1), '0') AS BIGINT) AS doc_key FROM x""",
        "es_amount_parse": _EVENTS + """, x AS (SELECT tx_id,
            translate(format('{:,.2f}', CAST(amount * 37 AS DOUBLE)), ',.', '.,') AS text FROM led)
          SELECT tx_id, text, CAST(CAST(replace(replace(text, '.', ''), ',', '.') AS DECIMAL(18,2)) AS DOUBLE) AS amount
          FROM x""",
        "dayfirst_parse": _EVENTS + """, x AS (SELECT tx_id, CASE WHEN movement_type = 'Premio'
            THEN '31/02/2024 10:00:00' ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS text FROM led)
          SELECT tx_id, text, try_strptime(text, '%d/%m/%Y %H:%M:%S') AS ts FROM x""",
        "fold_text": _EVENTS + """, x AS (SELECT tx_id, description || ' ÁÉÍÓÚ Ñandú Über' AS text FROM led)
          SELECT tx_id, text, lower(strip_accents(text)) AS folded FROM x""",
        "fold_scripts": _EVENTS + """SELECT tx_id, description || ' 한글 각 ﬁn ½ 𝐀𝔘 É' AS text,
          lower(strip_accents(description)) || ' ' || list_reduce(list_transform([4370, 4449, 4523, 4352, 4467,
            4527, 32, 4352, 4449, 4520], lambda c: chr(c)), lambda a, b: a || b) || ' fin 1' || chr(8260)
            || '2 au e' AS folded FROM led""",
        "enriched_bets": EU + """SELECT ts AS "Fecha", doc_id AS "Documento", username AS "Usuario",
          email AS "Correo", game AS "Juego", CAST(amount AS DOUBLE) AS "Importe"
          FROM bets JOIN users ON doc_id = user_id""",
        "modo_movements": E + """SELECT doc_id AS "Documento", ts AS "Fecha", CAST(amount AS DOUBLE) AS "Importe"
          FROM modo""",
        "load_feed": E + """SELECT ts AS "Fecha", day AS "Fecha_Dia", CAST(hour(ts) AS INTEGER) AS "Hora",
          doc_id AS "Documento", CASE channel WHEN 'MODO' THEN 'MODO' ELSE 'Retail' END AS "Metodo",
          channel AS "Canal", CAST(amount AS DOUBLE) AS "Importe" FROM loads""",
        "money_text": _EVENTS + """SELECT tx_id, CAST(amount * 1000 AS VARCHAR) AS text,
          '$' || format('{:,.2f}', CAST(amount * 1000 AS DOUBLE)) AS money FROM led""",
        "daily_rollup": E + """SELECT doc_id, day, CASE WHEN is_bet THEN game END AS game,
          CASE WHEN is_load THEN channel END AS channel, is_bet, is_load, count(amount) AS n,
          CAST(sum(amount) AS DOUBLE) AS amount, min(ts) AS first_ts, max(ts) AS last_ts
          FROM cls GROUP BY doc_id, day, 3, 4, is_bet, is_load, is_withdrawal, is_prize, is_bonus,
          CASE WHEN is_bonus THEN regexp_matches(t || ' ' || d, 'registro|alta|bienvenida') END""",
        "distinct_users_cube": E + """SELECT CASE
            WHEN grouping(day) = 0 AND grouping(game) = 0 THEN 'day_game' WHEN grouping(day) = 0 THEN 'day'
            WHEN grouping(month) = 0 AND grouping(game) = 0 THEN 'month_game' WHEN grouping(month) = 0 THEN 'month'
            WHEN grouping(game) = 0 THEN 'game' ELSE 'all' END AS level,
          day, month, game, count(DISTINCT doc_id) AS users
          FROM bets WHERE doc_id IS NOT NULL AND day IS NOT NULL AND game IS NOT NULL GROUP BY GROUPING SETS (
            (day, month, game), (day, month), (month, game), (month), (game), ())""",
        **files.oracles(),
        **streams.oracles(),
    }
