"""Scalar operators on their documented examples; `statuta.plans.scalars` runs the same operators over whole tables."""

import pytest
from pyspark.sql import functions as F

from statuta.functions import dates, identifiers, text, values

#: name: (schema of an example, expression, [(example, expected)])
CASES = {
    "act_signature": ("s string", lambda: identifiers.act_path(F.col("s")), [
        (("Dz.U. 2024 poz. 18",), "/acts/DU/2024/18"), (("WDU20240000018",), "/acts/WDU20240000018"), (("DU/2024/18",), "/acts/DU/2024/18"),
        (("M.P. 2023 poz. 7",), "/acts/MP/2023/7"), (("DU 2024 018",), "/acts/DU/2024/18"), (("no number",), None), (("poz. 55 z 2021",), "/acts/DU/2021/55")]),
    "celex_norm": ("s string", lambda: identifiers.celex(F.col("s")), [
        (("reg/2016/679",), "32016R0679"), (("CELEX:32016R0679",), "32016R0679"), (("02016R0679-20160504",), "02016R0679-20160504"),
        (("http://data.europa.eu/eli/dir/2019/790/oj",), "32019L0790"), (("12012P/TXT",), "12012P/TXT"), (("regulation",), None)]),
    "celex_base": ("s string", lambda: identifiers.base_of_consolidated(F.col("s")), [
        (("02016R0679-20160504",), "32016R0679"), (("32016R0679",), "32016R0679")]),
    "urn_of_signature": ("s string", lambda: identifiers.urn(F.col("s")), [
        (("DKN.5131.9.2025",), "urn:ndoc:gov:pl:uodo:2025:dkn_5131_9"), (("II SA/Wa 1030/19",), "urn:ndoc:court:pl:sa:2019:ii_sa-wa_1030"), (("I SAB/Kr 7/2020",), "urn:ndoc:court:pl:sa:2020:i_sab-kr_7"), (("V ACa 12/98",), "urn:ndoc:court:pl:sp:1998:v_aca_12"),
        (("III OSK 3945/21",), "urn:ndoc:court:pl:sa:2021:iii_osk_3945"), (("ZSOŚS.421.25.2019",), "urn:ndoc:gov:pl:uodo:2019:zsoss_421_25"), (("URN:X",), "urn:x"), (("DKN",), None)]),
    "signature_of_urn": ("s string", lambda: identifiers.signature_of_urn(F.col("s")), [
        (("urn:ndoc:court:pl:sa:2019:ii_sa-wa_1030",), "II SA/Wa 1030/19"), (("urn:ndoc:court:pl:sa:2021:iii_osk_3945",), "III OSK 3945/21"),
        (("urn:ndoc:court:eu:tsue:2022:c_621",), "C-621/22"), (("urn:other",), "urn:other"), (("urn:ndoc:court:pl:sp:1998:v_aca_12",), "V ACa 12/98"), (("URN:ndoc:court:pl:sp:2020:iii_agco_7_p",), "III AGCO 7/20"), (("urn:ndoc:court:pl:sp:2020:i_nsm_3_p_20200101",), "I Nsm 3/20"), (("urn:ndoc:court:pl:sa:2020:i_sab",), "urn:ndoc:court:pl:sa:2020:i_sab")]),
    "document_id": ("s string", lambda: identifiers.document_id(F.col("s")), [
        (("https://x.pl/s?id=150505_1&n=2",), "150505_1"), (("123456",), "123456"), (("https://x.pl/doc/A1B2C3",), "A1B2C3"), (("abc",), None)]),
    "case_number": ("s string", lambda: F.concat_ws("|", identifiers.case_number(F.col("s")), identifiers.case_year(F.col("s")).cast("string")), [
        ((" ii  ca 5/16 ",), "II CA 5/16|2016"), (("I C 9/99",), "I C 9/99|1999"), (("I C 9/2021",), "I C 9/2021|2021"), (("x",), "X")]),
    "court_of_signature": ("s string", lambda: identifiers.court_of(F.col("s")), [
        (("KIO 12/20",), "NATIONAL_APPEAL_CHAMBER"), (("K 35/15",), "CONSTITUTIONAL_TRIBUNAL"), (("III CZP 81/16",), "SUPREME"), (("I ACa 5/20",), "COMMON"), (("II Xyz 5/20",), None), (("IV K 7/21",), "COMMON"), (("abc",), None)]),
    "organ_mark": ("s string", lambda: identifiers.organ_mark(F.col("s")), [(("decyzja DKN.5131.9.2025 z dnia",), "DKN.5131.9.2025"), (("bez znaku",), None)]),
    "judgment_signatures": ("s string", lambda: F.array_join(identifiers.judgment_signatures(F.col("s")), "; "), [
        (("por. II SA/Wa 1030/19, III OSK 377/23 i II SA/Wa 1030/19",), "II SA/Wa 1030/19; III OSK 377/23"), (("nic",), "")]),
    "cited_positions": ("s string", lambda: F.array_join(identifiers.cited_positions(F.col("s")), "; "), [
        (("(Dz. U. z 2023 r. poz. 5 i 7 oraz Dz. U. z 2024 r. poz. 9)",), "2023/5; 2023/7; 2024/9"), (("nic",), "")]),
    "citation_form": ("p string, y int, n int, c boolean", lambda: identifiers.citation(F.col("p"), F.col("y"), F.col("n"), F.col("c")), [
        (("DU", 2024, 18, True), "t.j. Dz. U. z 2024 r. poz. 18"), (("MP", 2023, 7, False), "M. P. z 2023 r. poz. 7")]),
    "nip_regon": ("s string", lambda: F.concat_ws("|", identifiers.nip_ok(F.col("s")).cast("string"), identifiers.regon_ok(F.col("s")).cast("string")), [
        (("573-233-19-63",), "true|false"), (("5732331964",), "false|false"), (("123456785",), "false|true"), (("12345678512347",), "false|true"), (("x",), "false|false")]),
    "article_key": ("s string", lambda: identifiers.article_key(F.col("s")), [
        (("art. 4¹",), "4^1"), (("art. 4(1)",), "4^1"), (("Art. 4^1",), "4^1"), (("art. 130(1a)",), "130^1a"), (("art. 5b",), "5b"), (("§ 5",), "")]),
    "unit_key": ("s string", lambda: identifiers.unit_key(F.col("s")), [(("5b",), "5b"), (("4 1",), "4^1"), (("477 6 a",), "477^6a"), (("",), "")]),
    "article_list": ("s string", lambda: F.concat_ws("|", F.array_join(identifiers.unit_list(F.col("s"))["keys"], ","), F.array_join(identifiers.unit_list(F.col("s"))["ranges"], ",")), [
        (("5, 6 i 8",), "5,6,8|"), (("art. 5–7",), "5,6,7|"), (("479 88a–479 88j",), "479^88a,479^88j|479^88a..479^88j"), (("4 1 i 4 2",), "4^1,4^2|"), (("art. 7a oraz 9–2",), "2,7a,9|9..2")]),
    "range_membership": ("k string, a string, b string", lambda: identifiers.in_range(F.col("k"), F.col("a"), F.col("b")).cast("string"), [
        (("479^88c", "479^88a", "479^88j"), "true"), (("480", "479^88a", "479^88j"), "false"), (("x", "1", "2"), "false")]),
    "title_identity": ("a string, b string", lambda: identifiers.same_act(F.col("a"), F.col("b")).cast("string"), [
        (("Ustawa o ochronie danych osobowych", "ustawy o ochronie danych osobowych"), "true"), (("Kodeks cywilny", "Kodeks karny"), "false")]),
    "follow_up_query": ("n string, c string", lambda: identifiers.follow_up(F.col("n"), F.col("c")), [
        (("I C 5/20", "SO Warszawa"), 'signature "I C 5/20" --court "SO Warszawa"'), (("I C 5/20", None), 'signature "I C 5/20"')]),
    "voided_units": ("s string", lambda: F.array_join(identifiers.voided_units(F.col("s")), "; "), [
        (("Sąd stwierdza nieważność § 4 ust. 2, § 11 i § 4 ust. 5 regulaminu do zarządzenia wójta",), "§ 4; § 11"),
        (("nieważność zarządzenia w części obejmującej art. 6a i § 2, w pozostałej oddala § 9",), "art. 6a; § 2"), (("nieważność rozporządzenia w całości",), ""), (("nieważność uchwały dotyczącej zmiany § 7 statutu",), "")]),
    "polish_date": ("s string", lambda: dates.polish_date(F.col("s")).cast("string"), [
        (("9 listopada 2021",), "2021-11-09"), (("Warszawa, dnia 22 października 2021 r.",), "2021-10-22"), (("2021-02-03",), "2021-02-03"), (("31 lutego 2021",), None), (("x",), None)]),
    "date_in_words": ("s string", lambda: dates.in_words(F.col("s").cast("date")), [(("2021-11-09",), "9 listopada 2021 r.")]),
    "warsaw_date": ("s string", lambda: dates.local_date(F.col("s")).cast("string"), [
        (("2026-03-08T23:00:00Z",), "2026-03-09"), (("2026-07-08T21:59:00Z",), "2026-07-08"), (("2026-07-08T22:00Z",), "2026-07-09"), (("2026-03-08",), "2026-03-08"), (("x",), None)]),
    "sentinel_dates": ("s string", lambda: dates.known_date(F.col("s")).cast("string"), [
        (("31.12.2020",), "2020-12-31"), (("2020-05-06T00:00:00",), "2020-05-06"), (("9999-12-31",), None), (("0001-01-01T00:00:00",), None), (("2099-12-31",), None)]),
    "partial_date_range": ("s string", lambda: F.concat_ws("..", dates.widened(F.col("s"), False).cast("string"), dates.widened(F.col("s"), True).cast("string")), [
        (("2024",), "2024-01-01..2024-12-31"), (("2024-02",), "2024-02-01..2024-02-29"), (("2024-02-05",), "2024-02-05..2024-02-05"), (("2024-13",), "")]),
    "last_entry_date": ("s string", lambda: F.concat_ws("|", dates.entry_date(F.col("s")).cast("string"), dates.undated_entry(F.col("s"))), [
        (("rozdział drugi wejdzie w życie z dniem 3 maja 2027 r., pozostałe wejdzie w życie z dniem 9 czerwca 2029 r.",), "2029-06-09|"),
        (("wejdzie w życie z dniem określonym w komunikacie",), "announcement"), (("wejdzie w życie po upływie 7 dni",), "unknown"), (("zmieniony",), "")]),
    "swapped_dates": ("a string, b string", lambda: F.concat_ws("..", dates.ordered_dates(F.col("a"), F.col("b"))["made"], dates.ordered_dates(F.col("a"), F.col("b"))["published"]), [
        (("2024-03-01", "2024-02-01"), "2024-02-01..2024-03-01"), (("2024-01-01", "2024-02-01"), "2024-01-01..2024-02-01")]),
    "end_of_validity": ("d array<string>, p array<string>", lambda: F.concat_ws("|", F.coalesce(dates.end_of_validity(F.col("d"), F.col("p"))["end"], F.lit("-")), F.array_join(dates.end_of_validity(F.col("d"), F.col("p"))["partial"], ",")), [
        ((["2022-01-27", "9999-12-31"], []), "9999-12-31|2022-01-27"), ((["2020-01-01", "2021-01-01"], ["2021-01-01"]), "2020-01-01|2021-01-01"), ((["2021-01-01"], ["2021-01-01"]), "-|2021-01-01")]),
    "number_parse": ("s string", lambda: F.concat_ws("|", values.amount(F.col("s")).cast("string"), values.amount_text(values.amount(F.col("s")))), [
        (("1 000 000,50",), "1000000.50|1 000 000,50"), (("5015",), "5015.00|5 015,00"), (("x",), "—")]),
    "plural_form": ("n int", lambda: values.plural(F.col("n"), "trafienie", "trafienia", "trafień"), [((1,), "1 trafienie"), ((22,), "22 trafienia"), ((205,), "205 trafień"), ((112,), "112 trafień")]),
    "in_language": ("m map<string,string>", lambda: values.in_language(F.col("m")), [(({"pl": "tak", "en": "yes"},), "tak"), (({"en": "yes"},), "yes"), (({},), None)]),
    "as_list": ("v array<string>", lambda: F.array_join(values.as_list(F.col("v")), "; "), [((["a", "", None, "b"],), "a; b"), ((None,), "")]),
    "last_date_wins": ("e array<struct<use:string,date:string>>", lambda: F.concat_ws("|", *[F.element_at(values.last_by_use(F.col("e")), u) for u in ("announced", "validation")]), [
        (([("announced", "2020-01-01"), ("validation", "2020-02-01"), ("announced", "2021-01-01")],), "2021-01-01|2020-02-01")]),
    "lower_keys": ("s string", lambda: values.lower_keys(F.col("s")), [(('{"Items":"a","TotalCount":"2"}',), '{"items":"a","totalcount":"2"}')]),
    "phrase_folding": ("s string", lambda: F.concat_ws("|", text.folded(F.col("s")), text.dashes_folded(F.col("s"))), [(("ŁÓDŹ – Plan",), "lodz – plan|łódź - plan")]),
    "html_entities": ("s string", lambda: text.html_text(F.col("s")), [(("<p>a&nbsp;&amp; b</p><script>x</script><p>c<br/>d</p>",), "a & b\nc\nd")]),
    "ocr_repair": ("s string", lambda: text.ocr_repaired(F.col("s")), [(("$ 5 oraz art. 7 8 2 Ustawy, o którym mowa w 8 3 ust. 1",), "§ 5 oraz art. 7 § 2 Ustawy, o którym mowa w § 3 ust. 1"), (("w 8 dni",), "w 8 dni")]),
    "mojibake_repair": ("s string", lambda: text.mojibake_repaired(F.col("s")), [(("uchwa≥a",), "uchwała"), (("już ≥ 5",), "już ≥ 5")]),
    "dehyphenation": ("s string", lambda: text.dehyphenated(F.col("s")), [(("rozpo-\nrządzenie, biało-\n-czerwony",), "rozporządzenie, biało-czerwony")]),
    "damaged_citation": ("s string", lambda: F.array_join(text.damage_reasons(F.col("s")), "; "), [(("art. 5 ustawy poz. 7",), ""), (("art. ustawy poz. ",), "article without number; position missing")]),
    "correction_scope": ("s string", lambda: F.array_join(text.correction_scope(F.col("s")), ","), [(("Article 12, article 3a and Article 3, Article 12",), "3,3a,12")]),
}



@pytest.mark.parametrize("name", sorted(CASES))
def test_examples(spark, name):
    schema, expression, examples = CASES[name]
    table = spark.createDataFrame([(i, *args) for i, (args, _) in enumerate(examples)], f"i int, {schema}")
    got = {r["i"]: r["result"] for r in table.select("i", expression().cast("string").alias("result")).collect()}
    assert [got[i] for i in range(len(examples))] == [want for _, want in examples]
