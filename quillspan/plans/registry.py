"""Static dimension tables: federal titles, state codes and rules, counties and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values.
TITLES = [
    (7, "Agriculture", ["food-retail", "food-safety"]),
    (9, "Animals and Animal Products", ["food-safety"]),
    (21, "Food and Drugs", ["food-safety", "pharmacy"]),
    (27, "Alcohol, Tobacco, Products and Firearms", ["alcohol"]),
    (29, "Labor", ["employment"]),
    (40, "Protection of Environment", ["fuel", "hazmat"]),
    (49, "Transportation", ["fuel", "transportation"]),
]
CODES = [
    ("OC", "Occupations Code", "Occ. Code", ["licensing", "professional-regulation"]),
    ("HS", "Health & Safety Code", "Health & Safety Code", ["food-safety", "pharmacy", "hazmat"]),
    ("AL", "Alcoholic Beverage Code", "Alco. Bev. Code", ["alcohol"]),
    ("TX", "Tax Code", "Tax Code", ["tax"]),
    ("LA", "Labor Code", "Lab. Code", ["employment"]),
    ("PE", "Penal Code", "Penal Code", ["criminal", "fraud"]),
    ("BC", "Business & Commerce Code", "Bus. & Com. Code", ["consumer-protection", "contracts"]),
    ("IN", "Insurance Code", "Ins. Code", ["insurance"]),
    ("AG", "Agriculture Code", "Agric. Code", ["food-safety", "food-retail"]),
    ("BO", "Business Organizations Code", "Bus. Orgs. Code", ["corporate"]),
    ("CP", "Civil Practice & Remedies Code", "Civ. Prac. & Rem. Code", ["litigation"]),
    ("CR", "Criminal Procedure Code", "Crim. Proc. Code", ["criminal"]),
    ("ED", "Education Code", "Educ. Code", ["education"]),
    ("EL", "Election Code", "Elec. Code", ["elections"]),
    ("ES", "Estates Code", "Estates Code", ["estates"]),
    ("FA", "Family Code", "Fam. Code", ["family"]),
    ("FI", "Finance Code", "Fin. Code", ["banking", "finance"]),
    ("GV", "Government Code", "Gov't Code", ["government"]),
    ("HR", "Human Resources Code", "Hum. Res. Code", ["social-services"]),
    ("LG", "Local Government Code", "Loc. Gov't Code", ["local-government"]),
    ("NR", "Natural Resources Code", "Nat. Res. Code", ["natural-resources"]),
    ("PW", "Parks & Wildlife Code", "Parks & Wild. Code", ["parks"]),
    ("PR", "Property Code", "Prop. Code", ["property", "real-estate"]),
    ("SD", "Special District Local Laws Code", "Spec. Dist. Local Laws Code", ["special-districts"]),
    ("TN", "Transportation Code", "Transp. Code", ["transportation"]),
    ("UT", "Utilities Code", "Util. Code", ["utilities"]),
    ("WA", "Water Code", "Water Code", ["water"]),
]
RULES = [
    (16, "Economic Regulation", ["alcohol", "licensing"]),
    (22, "Health Services", ["pharmacy", "food-safety"]),
    (25, "Environmental Quality", ["environmental", "hazmat"]),
    (30, "Environmental Quality", ["environmental", "water"]),
    (37, "Public Safety and Corrections", ["licensing", "professional-regulation"]),
]
COUNTIES = [
    ("Harris", "48201", "municode", ["subdivision", "infrastructure", "flood", "health"]),
    ("Dallas", "48113", "elaws", ["subdivision", "building", "flood", "health"]),
    ("Tarrant", "48439", "municode", ["subdivision", "building", "drainage", "health"]),
    ("Bexar", "48029", "municode", ["subdivision", "building", "flood", "health"]),
    ("Travis", "48453", "municode", ["subdivision", "building", "flood", "septic", "health"]),
    ("Collin", "48085", "municode", ["subdivision", "building", "drainage", "health"]),
    ("Denton", "48121", "municode", ["subdivision", "building", "flood", "health"]),
    ("Fort Bend", "48157", "municode", ["subdivision", "building", "drainage", "flood", "health"]),
    ("Williamson", "48491", "municode", ["subdivision", "building", "flood", "septic", "health"]),
    ("El Paso", "48141", "municode", ["subdivision", "building", "flood", "health"]),
]
CITIES = [
    ("Houston", "houston", "municode"), ("San Antonio", "san_antonio", "municode"), ("Austin", "austin", "municode"), ("El Paso", "el_paso", "municode"),
    ("Arlington", "arlington", "municode"), ("Plano", "plano", "municode"), ("Corpus Christi", "corpus_christi", "municode"), ("Lubbock", "lubbock", "municode"),
    ("Laredo", "laredo", "municode"), ("Irving", "irving", "municode"), ("Garland", "garland", "municode"), ("Frisco", "frisco", "municode"),
    ("McKinney", "mckinney", "municode"), ("Amarillo", "amarillo", "municode"), ("Grand Prairie", "grand_prairie", "municode"), ("Brownsville", "brownsville", "municode"),
    ("Pasadena", "pasadena", "municode"), ("Dallas", "dallas", "amlegal"), ("Fort Worth", "fort_worth", "amlegal"), ("Killeen", "killeen", "amlegal"),
]

#: Base links of the cities on the second platform.
CITY_LINKS = {
    "dallas": "https://codelibrary.amlegal.com/codes/dallas/latest/dallas_tx/0-0-0-1",
    "fort_worth": "https://codelibrary.amlegal.com/codes/ftworth/latest/ftworth_tx/0-0-0-1",
    "killeen": "https://codelibrary.amlegal.com/codes/killeen/latest/killeen_tx/0-0-0-1",
}


def titles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*t, True) for t in TITLES], "number int, name string, categories array<string>, enabled boolean")


def codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*c, True) for c in CODES], "code string, name string, cited_as string, categories array<string>, enabled boolean")


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, True) for r in RULES], "number int, name string, categories array<string>, enabled boolean")


def counties(spark: SparkSession) -> DataFrame:
    base = lambda n, p: "http://dallascounty-tx.elaws.us/code/coor" if p == "elaws" else f"https://library.municode.com/tx/{n.lower().replace(' ', '_')}_county/codes/code_of_ordinances"
    return spark.createDataFrame([(n, f, p, base(n, p), c, True) for n, f, p, c in COUNTIES], "name string, fips string, platform string, base_url string, categories array<string>, enabled boolean")


def cities(spark: SparkSession) -> DataFrame:
    base = lambda i: CITY_LINKS.get(i) or f"https://library.municode.com/tx/{i}/codes/code_of_ordinances"
    return spark.createDataFrame([(n, i, p, base(i), True) for n, i, p in CITIES], "name string, city_id string, platform string, base_url string, enabled boolean")


def expected_jurisdictions(spark: SparkSession) -> DataFrame:
    """One row for each source that should be indexed: source_type, name, jurisdiction."""
    us = titles(spark).where("enabled").select(F.lit("federal").alias("source_type"), F.concat(F.lit("Title "), F.col("number").cast("string")).alias("name"), F.lit("US").alias("jurisdiction"))
    tx = codes(spark).where("enabled").select(F.lit("state").alias("source_type"), "name", F.lit("TX").alias("jurisdiction"))
    county = counties(spark).where("enabled").select(F.lit("county").alias("source_type"), "name", F.concat(F.lit("TX-"), "fips").alias("jurisdiction"))
    city = cities(spark).where("enabled").select(F.lit("municipal").alias("source_type"), "name", F.concat(F.lit("TX-"), "city_id").alias("jurisdiction"))
    return us.unionByName(tx).unionByName(county).unionByName(city)


def platform_stats(registry: DataFrame, enabled_only: bool = False) -> DataFrame:
    rows = registry.where("enabled") if enabled_only else registry
    return rows.groupBy("platform").agg(F.count(F.lit(1)).alias("sources"))


def lookup(registry: DataFrame, key: str, value: object, ignore_case: bool = False) -> DataFrame:
    """Rows whose key is value; names are compared without regard to case."""
    return registry.where(F.lower(key) == str(value).lower()) if ignore_case else registry.where(F.col(key) == value)
