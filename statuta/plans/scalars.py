"""Scalar operators over whole tables: every row of a table is spelled as a text, the operator reads it, and the oracle says what was meant.

Every result is (id, result): the row's key and the result as text (null where nothing is recognised). Inputs are Spark SQL over the table's columns
and y, n, d: a year, a number below 1,800 and an ISO date of the row; the oracle is DuckDB SQL over the same. k is the key, v the spelling's number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, identifiers, text, values
from ..functions.dates import MONTHS
from ..sources import tables

#: name: (inputs as Spark SQL, expression, oracle as DuckDB SQL)
ORDERS: dict[str, tuple[dict[str, str], Callable[[], Column], str]] = {}
_MONTHS = ", ".join(f"'{m}'" for m in MONTHS)
SPOKEN_SPARK = f"concat(day(o_orderdate), ' ', element_at(array({_MONTHS}), month(o_orderdate)), ' ', y)"
SPOKEN = f"day(o_orderdate) || ' ' || [{_MONTHS}][month(o_orderdate)] || ' ' || y"
TWO = "lpad(CAST(y % 100 AS STRING), 2, '0')"
TWO_SQL = "lpad((y % 100)::VARCHAR, 2, '0')"
FOUR, FOUR_SQL = "lpad(CAST(n AS STRING), 4, '0')", "lpad(n::VARCHAR, 4, '0')"


def _pick(*spellings: str) -> str:
    """One of the spellings by v; for both dialects."""
    whens = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(spellings))
    return f"CASE v % {len(spellings)} {whens} END"


def over_orders(name: str, expression: Callable[[], Column], oracle: str, **inputs: str) -> None:
    ORDERS[name] = inputs, expression, oracle


S = lambda: F.col("s")

over_orders(
    "act_signature", lambda: identifiers.act_path(S()),
    _pick("'/acts/DU/' || y || '/' || n", "'/acts/DU/' || y || '/' || n", "'/acts/MP/' || y || '/' || n", "'/acts/DU/' || y || '/' || n", "'/acts/WDU' || y || lpad(n::VARCHAR, 7, '0')", "NULL"),
    s=_pick("concat('Dz.U. ', y, ' poz. ', n)", "concat('DU/', y, '/0', n)", "concat('M.P. ', y, ' poz. ', n)", "concat('poz. ', n, ' z ', y)", "concat('WDU', y, lpad(CAST(n AS STRING), 7, '0'))", "'no number'"),
)
over_orders(
    "celex_norm", lambda: identifiers.celex(S()),
    _pick(f"'3' || y || 'R' || {FOUR_SQL}", f"'3' || y || 'L' || {FOUR_SQL}", f"'3' || y || 'D' || {FOUR_SQL}", f"'0' || y || 'R' || {FOUR_SQL} || '-' || strftime(o_orderdate, '%Y%m%d')", "NULL"),
    s=_pick("concat('reg/', y, '/', n)", "concat('http://data.europa.eu/eli/dir/', y, '/', n, '/oj')", f"concat('CELEX:3', y, 'D', {FOUR})", f"concat('0', y, 'R', {FOUR}, '-', date_format(o_orderdate, 'yyyyMMdd'))", "concat('regulation ', n)"),
)
over_orders(
    "celex_base", lambda: identifiers.base_of_consolidated(S()), f"'3' || y || 'R' || {FOUR_SQL}",
    s=_pick(f"concat('0', y, 'R', {FOUR}, '-', date_format(o_orderdate, 'yyyyMMdd'))", f"concat('3', y, 'R', {FOUR})"),
)
over_orders(
    "urn_of_signature", lambda: identifiers.urn(S()),
    _pick("'urn:ndoc:court:pl:sa:' || y || ':ii_sa-wa_' || n", "'urn:ndoc:court:pl:sa:' || y || ':iii_osk_' || n", "'urn:ndoc:gov:pl:uodo:' || y || ':dkn_' || n || '_' || o_custkey", "'urn:ndoc:court:pl:sp:' || y || ':v_aca_' || n", "NULL"),
    s=_pick(f"concat('II SA/Wa ', n, '/', {TWO})", "concat('III OSK ', n, '/', y)", "concat('DKN.', n, '.', o_custkey, '.', y)", f"concat('V ACa ', n, '/', {TWO})", "'DKN'"),
)
over_orders(
    "signature_of_urn", lambda: identifiers.signature_of_urn(S()), _pick(f"'II SA/Wa ' || n || '/' || {TWO_SQL}", f"'C-' || n || '/' || {TWO_SQL}", f"'III OSK ' || n || '/' || {TWO_SQL}", "'urn:other:' || n"),
    s=_pick("concat('urn:ndoc:court:pl:sa:', y, ':ii_sa-wa_', n)", "concat('urn:ndoc:court:eu:tsue:', y, ':c_', n)", "concat('urn:ndoc:court:pl:sa:', y, ':iii_osk_', n)", "concat('urn:other:', n)"),
)
over_orders(
    "document_id", lambda: identifiers.document_id(S()), _pick("(10000 + n) || '_1'", "k::VARCHAR", "'A' || n", "NULL"),
    s=_pick("concat('https://x.pl/s?id=', 10000 + n, '_1&n=2')", "CAST(k AS STRING)", "concat('https://x.pl/doc/A', n)", "'abc'"),
)
over_orders(
    "case_number", lambda: F.concat_ws("|", identifiers.case_number(S()), identifiers.case_year(S()).cast("string")), _pick(f"'II CA ' || n || '/' || {TWO_SQL} || '|' || y", "'I C ' || n || '/' || y || '|' || y", "'X'"),
    s=_pick(f"concat(' ii  ca ', n, '/', {TWO}, ' ')", "concat('I C ', n, '/', y)", "'x'"),
)
over_orders(
    "court_of_signature", lambda: identifiers.court_of(S()), _pick("'NATIONAL_APPEAL_CHAMBER'", "'CONSTITUTIONAL_TRIBUNAL'", "'SUPREME'", "'COMMON'", "NULL", "'COMMON'"),
    s=_pick(*[f"concat('{x} ', n, '/', {TWO})" for x in ("KIO", "K", "III CZP", "I ACa", "II Xyz", "IV K")]),
)
over_orders("organ_mark", lambda: identifiers.organ_mark(S()), _pick("'DKN.' || n || '.' || o_custkey || '.' || y", "NULL"), s=_pick("concat('decyzja DKN.', n, '.', o_custkey, '.', y, ' z dnia')", "concat('bez znaku ', n)"))
over_orders(
    "judgment_signatures", lambda: F.array_join(identifiers.judgment_signatures(S()), "; "), _pick(f"'II SA/Wa ' || n || '/' || {TWO_SQL} || '; III OSK ' || o_custkey || '/' || {TWO_SQL}", "''"),
    s=_pick(f"concat('por. II SA/Wa ', n, '/', {TWO}, ', III OSK ', o_custkey, '/', {TWO}, ' i II SA/Wa ', n, '/', {TWO})", "concat('nic ', n)"),
)
over_orders(
    "cited_positions", lambda: F.array_join(identifiers.cited_positions(S()), "; "), _pick("y || '/' || n || '; ' || y || '/' || (n + 1) || '; ' || (y + 1) || '/' || (n + 2)", "''"),
    s=_pick("concat('(Dz. U. z ', y, ' r. poz. ', n, ' i ', n + 1, ' oraz Dz. U. z ', y + 1, ' r. poz. ', n + 2, ')')", "'nic'"),
)
over_orders(
    "citation_form", lambda: identifiers.citation(F.col("p"), F.col("year"), F.col("number"), F.col("whole")),
    "CASE WHEN v % 2 = 0 THEN 't.j. ' ELSE '' END || CASE o_orderstatus WHEN 'F' THEN 'Dz. U.' WHEN 'O' THEN 'M. P.' ELSE 'X' END || ' z ' || y || ' r. poz. ' || n",
    p="CASE o_orderstatus WHEN 'F' THEN 'DU' WHEN 'O' THEN 'MP' ELSE 'X' END", year="y", number="n", whole="v % 2 = 0",
)
_SUM = "list_sum(list_transform(range(1, {last}), lambda i: CAST(x[i] AS INTEGER) * [{weights}][i])) % 11"
over_orders(
    "nip_regon", lambda: F.concat_ws("|", identifiers.nip_ok(S()).cast("string"), identifiers.regon_ok(S()).cast("string")),
    "(SELECT CASE WHEN length(x) = 10 THEN CASE WHEN " + _SUM.format(last=10, weights="6, 5, 7, 2, 3, 4, 5, 6, 7") + " = x[10]::INTEGER THEN 'true|false' ELSE 'false|false' END WHEN ("
    + _SUM.format(last=9, weights="8, 9, 2, 3, 4, 5, 6, 7") + ") % 10 = x[9]::INTEGER THEN 'false|true' ELSE 'false|false' END FROM (SELECT CASE v % 2 WHEN 0 THEN lpad((k * 7919)::VARCHAR, 9, '0')[1:9] || (k % 10) ELSE lpad((k * 7919)::VARCHAR, 9, '0')[1:9] END AS x))",
    s=_pick("concat(left(lpad(CAST(k * 7919 AS STRING), 9, '0'), 9), k % 10)", "left(lpad(CAST(k * 7919 AS STRING), 9, '0'), 9)"),
)
over_orders(
    "article_key", lambda: identifiers.article_key(S()), _pick("n || '^1'", "n || '^2'", "n || '^1'", "n || 'b'", "n || '^1a'", "''"),
    s=_pick("concat('art. ', n, '¹')", "concat('Art. ', n, '^2')", "concat('art. ', n, '(1)')", "concat('art. ', n, 'b')", "concat('art. ', n, '(1a)')", "concat('§ ', n)"),
)
over_orders("unit_key", lambda: identifiers.unit_key(S()), _pick("n || 'b'", "n || '^1'", "n || '^6a'", "''"), s=_pick("concat(n, 'B')", "concat(' ', n, ' 1')", "concat(n, ' 6 a')", "''"))
_SORTED = "array_to_string(list_sort(list_distinct([{0}])), ',')"
over_orders(
    "article_list", lambda: F.concat_ws("|", F.array_join(identifiers.unit_list(S())["keys"], ","), F.array_join(identifiers.unit_list(S())["ranges"], ",")),
    _pick(_SORTED.format("n::VARCHAR, (n + 1)::VARCHAR, (n + 3)::VARCHAR") + " || '|'", _SORTED.format("n::VARCHAR, (n + 1)::VARCHAR, (n + 2)::VARCHAR") + " || '|'", "n || '^88a,' || n || '^88j|' || n || '^88a..' || n || '^88j'",
          _SORTED.format("n || '^1', n || '^2'") + " || '|'", _SORTED.format("n::VARCHAR, (n + 900)::VARCHAR") + " || '|' || n || '..' || (n + 900)"),
    s=_pick("concat(n, ', ', n + 1, ' i ', n + 3)", "concat('art. ', n, '–', n + 2)", "concat(n, ' 88a–', n, ' 88j')", "concat(n, ' 1 i ', n, ' 2')", "concat(n, '–', n + 900)"),
)
over_orders(
    "range_membership", lambda: identifiers.in_range(F.col("u"), F.col("a"), F.col("b")).cast("string"), "CASE WHEN n BETWEEN o_custkey AND o_custkey + 400 THEN 'true' ELSE 'false' END",
    u="concat(n, '^8c')", a="concat(o_custkey, '^8a')", b="concat(o_custkey + 400, 'j')",
)
over_orders(
    "title_identity", lambda: identifiers.same_act(F.col("a"), F.col("b")).cast("string"), _pick("'true'", "'false'", "'false'"),
    a="concat('Ustawa o ochronie danych spraw numer', k)", b=_pick("concat('ustawy o ochronie danych spraw numer', k)", "concat('Kodeks karny numer', k)", "concat('ustawy o ochronie zabytków numer', k)"),
)
over_orders(
    "follow_up_query", lambda: identifiers.follow_up(F.col("a"), F.col("b")), "'signature \"I C ' || n || '/' || y || '\"' || " + _pick("' --court \"SO ' || o_custkey || '\"'", "''"),
    a="concat('I C ', n, '/', y)", b=_pick("concat('SO ', o_custkey)", "CAST(NULL AS STRING)"),
)
over_orders(
    "voided_units", lambda: F.array_join(identifiers.voided_units(S()), "; "), _pick("'§ ' || n || '; § ' || (n + 1)", "'art. ' || n || 'a; § ' || (n + 1)", "''", "''"),
    s=_pick("concat('Sąd stwierdza nieważność § ', n, ' ust. 2, § ', n + 1, ' i § ', n, ' ust. 5 regulaminu do zarządzenia wójta')", "concat('nieważność zarządzenia w części obejmującej art. ', n, 'a i § ', n + 1, ', w pozostałej oddala § 9')",
            "concat('nieważność uchwały dotyczącej zmiany § ', n, ' statutu')", "concat('nieważność rozporządzenia nr ', n)"),
)
over_orders(
    "polish_date", lambda: dates.polish_date(S()).cast("string"), _pick("d", "d", "d", "NULL"),
    s=_pick(SPOKEN_SPARK, f"concat('Warszawa, dnia ', {SPOKEN_SPARK}, ' r. poz. ', n)", "d", "concat('31 lutego ', y)"),
)
over_orders("date_in_words", lambda: dates.in_words(F.col("s").cast("date")), f"{SPOKEN} || ' r.'", s="d")
over_orders(
    "warsaw_date", lambda: dates.local_date(S()).cast("string"), _pick("strftime(o_orderdate::DATE + 1, '%Y-%m-%d')", "d", "d", "NULL"),
    s=_pick("concat(d, 'T23:30:00Z')", "concat(d, 'T21:30Z')", "d", "concat('x', n)"),
)
over_orders(
    "sentinel_dates", lambda: dates.known_date(S()).cast("string"), _pick("d", "d", "NULL", "NULL"),
    s=_pick("date_format(o_orderdate, 'dd.MM.yyyy')", "concat(d, 'T00:00:00')", "'9999-12-31'", "'0001-01-01T00:00:00'"),
)
over_orders(
    "partial_date_range", lambda: F.concat_ws("..", dates.widened(S(), False).cast("string"), dates.widened(S(), True).cast("string")),
    _pick("y || '-01-01..' || y || '-12-31'", "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '..' || strftime(last_day(o_orderdate), '%Y-%m-%d')", "d || '..' || d", "''"),
    s=_pick("CAST(y AS STRING)", "left(d, 7)", "d", "concat(y, '-13')"),
)
over_orders(
    "last_entry_date", lambda: F.concat_ws("|", dates.entry_date(S()).cast("string"), dates.undated_entry(S())), _pick("d || '|'", "d || '|'", "'announcement'", "'unknown'", "''"),
    s=_pick(f"concat('rozdział drugi wejdzie w życie z dniem 3 maja 2027 r., pozostałe wejdzie w życie z dniem ', {SPOKEN_SPARK}, ' r.')", "concat('wejście w życie z dniem ', date_format(o_orderdate, 'dd.MM.yyyy'))",
            "concat('wejdzie w życie z dniem określonym w komunikacie nr ', n)", "concat('wejdzie w życie po upływie ', n, ' dni')", "concat('zmieniony poz. ', n)"),
)
over_orders(
    "swapped_dates", lambda: F.concat_ws("..", dates.ordered_dates(F.col("a"), F.col("b"))["made"], dates.ordered_dates(F.col("a"), F.col("b"))["published"]),
    "least(d, strftime(o_orderdate::DATE + CAST(n % 61 - 30 AS INTEGER), '%Y-%m-%d')) || '..' || greatest(d, strftime(o_orderdate::DATE + CAST(n % 61 - 30 AS INTEGER), '%Y-%m-%d'))",
    a="d", b="CAST(date_add(CAST(d AS DATE), CAST(n % 61 - 30 AS INT)) AS STRING)",
)
over_orders(
    "end_of_validity", lambda: F.concat_ws("|", F.coalesce(dates.end_of_validity(F.col("a"), F.col("b"))["end"], F.lit("-")), F.array_join(dates.end_of_validity(F.col("a"), F.col("b"))["partial"], ",")),
    _pick("'9999-12-31|' || d", "d || '|2020-01-01'", "'-|' || d"), a=_pick("array(d, '9999-12-31')", "array('2020-01-01', d)", "array(d)"), b=_pick("CAST(array() AS ARRAY<STRING>)", "array('2020-01-01')", "array(d)"),
)
over_orders(
    "number_parse", lambda: F.concat_ws("|", values.amount(S()).cast("string"), F.translate(values.amount_text(values.amount(S())), " ", " ")),
    _pick("n || '.50|' || n || ',50'", "(1000 + n % 1000) || '.00|1 ' || lpad((n % 1000)::VARCHAR, 3, '0') || ',00'", "'3000' || lpad((n % 1000)::VARCHAR, 3, '0') || '.05|3 000 ' || lpad((n % 1000)::VARCHAR, 3, '0') || ',05'", "'—'").replace("n || '.50|' || n", "(n % 1000) || '.50|' || (n % 1000)"),
    s=_pick("concat(n % 1000, ',50')", "CAST(1000 + n % 1000 AS STRING)", "concat('3 000 ', lpad(CAST(n % 1000 AS STRING), 3, '0'), ',05')", "'x'"),
)
over_orders(
    "plural_form", lambda: values.plural(F.col("c"), "trafienie", "trafienia", "trafień"), "k || ' ' || CASE WHEN k = 1 THEN 'trafienie' WHEN k % 10 BETWEEN 2 AND 4 AND NOT k % 100 BETWEEN 12 AND 14 THEN 'trafienia' ELSE 'trafień' END", c="k",
)
over_orders("in_language", lambda: values.in_language(F.col("m")), _pick("'tak ' || n", "'yes ' || n", "NULL"), m=_pick("map('pl', concat('tak ', n), 'en', 'yes')", "map('en', concat('yes ', n))", "CAST(map() AS MAP<STRING, STRING>)"))
over_orders("as_list", lambda: F.array_join(values.as_list(F.col("l")), "; "), _pick("d || '; ' || n", "''"), l=_pick("array(d, '', CAST(NULL AS STRING), CAST(n AS STRING))", "CAST(NULL AS ARRAY<STRING>)"))
over_orders(
    "last_date_wins", lambda: F.concat_ws("|", *[F.element_at(values.last_by_use(F.col("e")), u) for u in ("announced", "validation")]), "n || '|' || d",
    e="array(named_struct('use', 'announced', 'date', d), named_struct('use', 'validation', 'date', d), named_struct('use', 'announced', 'date', CAST(n AS STRING)))",
)
over_orders("lower_keys", lambda: values.lower_keys(S()), """'{"items":"' || d || '","totalcount":"' || n || '"}'""", s="""concat('{"Items":"', d, '","TotalCount":"', n, '"}')""")
over_orders("phrase_folding", lambda: F.concat_ws("|", text.folded(S()), text.dashes_folded(S())), "'lodz – plan ' || n || '|łódź - plan ' || n", s="concat('ŁÓDŹ – Plan ', n)")
over_orders("html_entities", lambda: text.html_text(S()), "'a & ' || n || chr(10) || d || chr(10) || 'd'", s="concat('<p>a&nbsp;&amp; ', n, '</p><script>x</script><p>', d, '<br/>d</p>')")
over_orders(
    "ocr_repair", lambda: text.ocr_repaired(S()), _pick("'§ ' || n || ' oraz art. ' || n || ' § 2 Ustawy'", "'o którym mowa w § ' || (n % 90 + 1) || ' ust. ' || n", "'w 8 dni od ' || d"),
    s=_pick("concat('$ ', n, ' oraz art. ', n, ' 8 2 Ustawy')", "concat('o którym mowa w 8 ', n % 90 + 1, ' ust. ', n)", "concat('w 8 dni od ', d)"),
)
over_orders("mojibake_repair", lambda: text.mojibake_repaired(S()), _pick("'uchwała nr ' || n", "'już ≥ ' || n"), s=_pick("concat('uchwa≥a nr ', n)", "concat('już ≥ ', n)"))
over_orders("dehyphenation", lambda: text.dehyphenated(S()), "'rozporządzenie ' || n || ', biało-czerwony ' || d", s="concat('rozpo-', chr(10), 'rządzenie ', n, ', biało-', chr(10), '-czerwony ', d)")
over_orders(
    "damaged_citation", lambda: F.array_join(text.damage_reasons(S()), "; "), _pick("''", "'article without number'", "'position missing'", "'journal number 0'"),
    s=_pick("concat('art. ', n, ' ustawy poz. ', n)", "concat('art. ustawy poz. ', n)", "concat('art. ', n, ' ustawy poz. ')", "concat('art. ', n, ' z ', y, ' r. Nr 0')"),
)
over_orders("correction_scope", lambda: F.array_join(text.correction_scope(S()), ","), "n || ',' || n || 'a,' || (n + 9)", s="concat('Article ', n + 9, ', article ', n, 'a and Article ', n, ', Article ', n + 9)")

_ROWS = "SELECT *, o_orderkey AS k, o_orderkey // 3 AS v, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey % 1800 + 1 AS n, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders"


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    inputs, expression, _ = ORDERS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = tables.table(spark, sf_dir, "orders").selectExpr("*", "o_orderkey AS k", "o_orderkey div 3 AS v", "year(o_orderdate) AS y", "o_orderkey % 1800 + 1 AS n", "date_format(o_orderdate, 'yyyy-MM-dd') AS d")
        spelled = rows.selectExpr("k AS id", *[f"{said} AS {name}" for name, said in inputs.items()])
        return spelled.select("id", expression().cast("string").alias("result"))

    return run


def queries() -> dict:
    return {name: _query(name) for name in ORDERS}


def oracle_sql() -> dict:
    return {name: f"SELECT k AS id, CAST({oracle} AS VARCHAR) AS result FROM ({_ROWS})" for name, (_, _, oracle) in ORDERS.items()}
