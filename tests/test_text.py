import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators.normalize import normalize

NAMES = {
    "Acme Pvt. Ltd.": "acme", "ACME PRIVATE LIMITED": "acme", "Acme Corp": "acme", "Inc Holy Ministries": "holy ministries",
    "Europ & Frères Distribution S.A.": "europ freres distribution", "The Sharma & Sons Private Limited": "sharma sons",
    "Dupont SARL": "dupont", "Durand SAS": "durand", "Smith Holdings LLC": "smith holdings", "The Company Ltd": "the company ltd",
}
CLEAN = {"  Café   Müller & Co.,  ": "cafe muller and co", "S.G. Joe's-Diner": "sg joes diner"}
ADDRESSES = {
    "12 MG Rd, Nr SBI ATM": "12 mg road near sbi atm", "Opp. City Mall, Blvd 5": "opposite city mall boulevard 5",
    "5 Av des Hêtres": "5 avenue des hetres", "10 Bd Victor Hugo": "10 boulevard victor hugo", "Pune, null, A-68": "pune a 68",
}
POSTCODES = {"532 1/2 Kestrel Ln, Pune 411001": "411001", "Boston MA 02134": "02134", "Call 9876543210 at 12 Main St": "", "12 Main St": "", "12345, 560001": "560001"}
CITIES = {
    "1130 COLUMBIA AVE, BRIDGEPORT, WA": "bridgeport", "9336 W Haven Dr, Portland, Oregon": "portland",
    "Columbia City, Indiana, 91 Tidewater Trail": "columbia city", "MA, 500 Quincy Street, Abington, Unit 3-C1": "abington",
    "17 Rue Gustave Delory, Lille, Hauts-de-France": "lille", "": "",
}


def one(spark, values, column):
    rows = spark.createDataFrame([(v,) for v in values], "x string").select("x", column.alias("y")).collect()
    return {r["x"]: r["y"] for r in rows}


@pytest.mark.parametrize("golden", ["NAMES", "CLEAN", "ADDRESSES", "POSTCODES", "CITIES"])
def test_golden(spark, golden):
    f = {
        "NAMES": lambda c: X.name_core(X.clean(X.fold(c))),
        "CLEAN": lambda c: X.clean(X.fold(c)),
        "ADDRESSES": lambda c: X.address(X.clean(X.fold(c))),
        "POSTCODES": lambda c: X.postcode(X.digit_runs(X.fold(c))),
        "CITIES": lambda c: X.city_token(X.fold(c)),
    }[golden]
    values = globals()[golden]
    assert one(spark, values, f(F.col("x"))) == values


def test_fold():
    assert X.ascii_fold(None) == "" and X.ascii_fold("plain") == "plain"
    assert X.ascii_fold("Straße Œuvre") == "Strasse OEuvre"
    assert X.ascii_fold("१२") == "12"
    assert X.ascii_fold("डिजिटल टेक").isascii() and X.ascii_fold("डिजिटल").startswith("ddi")


def test_other_scripts():
    got = {x: X.ascii_fold(x) for x in ("Москва Щука", "Αθήνα", "서울", "とうきょう", "القاهرة", "שלום", "मुंबई", "№5 ½", "北京")}
    assert got == {"Москва Щука": "Moskva Shchuka", "Αθήνα": "Athena", "서울": "seoul", "とうきょう": "toukiyou", "القاهرة": "alqahrh", "שלום": "shlvm", "मुंबई": "munbaii", "№5 ½": "No5 12", "北京": ""}


def test_digits_and_numbers(spark):
    got = one(spark, ["532 1/2 Kestrel Ln, Pune 411001", "१२ सड़क", "", "007 0 00"], X.digit_runs(X.fold(F.col("x"))))
    assert got["532 1/2 Kestrel Ln, Pune 411001"] == ["532", "1", "2", "411001"] and got["१२ सड़क"] == ["12"] and got[""] == []
    assert one(spark, ["007 0 00"], X.number_set(X.digit_runs(F.col("x"))))["007 0 00"] == ["7", "0"]


def test_id_lists(spark):
    got = one(spark, ["a, b,,c", "", " 1 , 12,1"], X.id_list(F.col("x")))
    assert got == {"a, b,,c": ["a", "b", "c"], "": [], " 1 , 12,1": ["1", "12"]}
    assert one(spark, ["b,a,b"], X.join_ids(F.split("x", ",")))["b,a,b"] == "a,b"


def test_grams(spark):
    got = one(spark, ["ab c", "", "x"], X.grams(F.col("x")))
    assert got == {"ab c": [" ab", "ab ", " c "], "": [], "x": [" x "]}


def test_normalize(spark):
    rows = spark.createDataFrame([("S2-1", "", "", ""), (" S1-1 ", "Café SARL", "3 Rue X, Lyon", " Atlantis "), ("S3-1", None, None, None)], "entity_id string, business_name string, business_address string, country string")
    got = {r["entity_id"]: r for r in normalize(rows).collect()}
    assert got["S2-1"]["source"] == "S2" and got["S2-1"]["name_core"] == "" and got["S2-1"]["numbers"] == [] and got["S2-1"]["name_tokens"] == []
    assert got["S1-1"]["country"] == "Atlantis" and got["S1-1"]["name_raw"] == "Café SARL" and got["S1-1"]["name_core"] == "cafe"
    assert got["S3-1"]["addr_norm"] == "" and got["S3-1"]["postcode"] == ""
