"""Static dimensions: contest types, contest registry, ignored categories, posters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPE_SCHEMA = "key string, id int, computational boolean, name string, choices boolean"
REGISTRY_SCHEMA = "grp string, name string, id long, ids array<long>, link string, kind string, `range` array<int>, dist int, infer boolean"

# Contest types (key, id, computational, name, choices).
TYPES = (
    ("OMMC", -1, True, "OMMC", False),
    ("AMC", 0, True, "AMC", True),
    ("AIME", 1, True, "AIME", False),
    ("AMO", 2, False, "US(J)AMO", False),
    ("HMMT", 4, True, "HMMT", False),
    ("COMPUTE", 97, True, "COMPUTE", False),
    ("ARML", 98, True, "ARML", False),
    ("UNKNOWN", 99, None, None, None),
)

# Ignored categories, the post of a copyright notice, the poster whose closing remark goes.
IGNORED = (4491998, 4479828, 3685109)
NOTICE_POST = 4956172
REMARK_POSTER = 167643

# The contest registry (group, name, id, further fields).
CONTESTS = (
    ("MAA", "AMC 8", 3413, {"range": [800, 1100], "dist": 1}),
    ("MAA", "AMC 10", 3414, {"range": [950, 1700], "dist": 2}),
    ("MAA", "AMC 12", 3415, {"range": [1050, 1900], "dist": 2}),
    ("MAA", "AIME", 3416, {"range": [1400, 2300], "dist": 1}),
    ("MAA", "USAMTS", 3412, {"link": "https://www.usamts.org/contest/past-problems/"}),
    ("CollegeComp", "CMIMC", 253928, {"link": "https://cmimc.math.cmu.edu/math/past-problems"}),
    ("CollegeComp", "CHMMC", 2746308, {"link": "https://www.caltechmathmeet.org/problems"}),
    ("CollegeComp", "HMMT", 3417, {"link": "https://www.hmmt.org/www/archive/problems"}),
    ("CollegeComp", "HMMT November", 2881068, {"link": "https://www.hmmt.org/www/archive/problems"}),
    ("CollegeComp", "SMT", 3418, {"link": "https://www.stanfordmathtournament.org/past-tests/problems"}),
    ("CollegeComp", "BMT", 2503467, {"link": "https://berkeley.mt/resources/"}),
    ("CollegeComp", "PUMAC", 3426, {"link": "https://pumac.princeton.edu/archives"}),
    ("CollegeComp", "BAMO", 233906, {"link": "https://www.bamo.org/archives/problems_and_solutions/"}),
    ("CollegeComp", "JHMT", 3347995, {"link": "https://www.johnshopkinsmathtournament.com/past-papers"}),
    ("Other", "MPFG", 3427, {"link": "https://mathprize.atfoundation.org/resources"}),
    ("Other", "MPFG Olympiad", 953466, {}),
    ("Other", "Purple Comet", 3419, {"link": "https://purplecomet.org/answers"}),
    ("Other", "OMMC", 2824982, {"link": "https://www.ommcofficial.org/"}),
    ("Other", "NIMO", 3423, {}),
    ("Other", "OMO", 3431, {}),
    ("Other", "EMCC", 4718194, {"link": "https://exetermathclub.com/archives"}),
    ("Other", "Putnam", 3249, {"link": "https://kskedlaya.org/putnam-archive/"}),
    ("Other", "mathleague.org", 134, {"kind": "forum"}),
    ("UserMocks", "AIME mocks", 2439872, {"kind": "collection"}),
    ("UserMocks", "USA Mocks", 2439870, {"kind": "collection"}),
    ("UserMocks", "USA Computational Geo Mocks", 3629353, {"kind": "collection"}),
    ("UserContestSeries", "CMC", 2402371, {"kind": "collection", "infer": True}),
    ("UserContestSeries", "OTIS Mock AIME", 4180954, {"kind": "collection"}),
    ("UserContestSeries", "OTSS", 1189415, {"kind": "collection"}),
    ("UserContestSeries", "MAC", 2442196, {"kind": "collection"}),
    ("UserContestSeries", "IMTC", 3632745, {"kind": "collection"}),
    ("UserContestSeries", "Nanomath", 3583112, {"kind": "collection"}),
    ("UserContestSeries", "Gaussian Curvature", 2442168, {"kind": "collection"}),
    ("UserContestSeries", "DMC", 2332005, {"kind": "collection"}),
    ("UserContestSeries", "ZeMC", None, {"ids": [2505703, 3211241, 3623297]}),
    ("UserContestSeries", "Solstice Math Olympiads", 3072130, {"kind": "forum"}),
    ("UserContestSeries", "2025 DISCUS AMC", 4624886, {"kind": "forum"}),
    ("UserContestSeries", "CNCM", 1282021, {"kind": "collection"}),
    ("NotMath", "F = MA", 3421, {"link": "https://aapt.org/physicsteam/PT-exams.cfm"}),
)
SEARCHED = ("MAA", "CollegeComp", "Other", "UserContestSeries", "UserMocks")


def types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYPES, TYPE_SCHEMA)


def registry(spark: SparkSession) -> DataFrame:
    fields = ("ids", "link", "kind", "range", "dist", "infer")
    return spark.createDataFrame([(g, n, i, *[more.get(f) for f in fields]) for g, n, i, more in CONTESTS], REGISTRY_SCHEMA)


def ignored(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in IGNORED], "item_id long")


def contests(spark: SparkSession) -> DataFrame:
    """What can be scraped: the searched groups with an id, without forums."""
    rows = registry(spark)
    groups = [rows.where(F.col("grp") == g) for g in SEARCHED]
    out = groups[0]
    for more in groups[1:]:
        out = out.unionByName(more)
    return out.where(F.col("id").isNotNull() & ~F.col("kind").eqNullSafe("forum"))


def series_contests(spark: SparkSession) -> DataFrame:
    """The contest series of users with an id, forums included."""
    return registry(spark).where((F.col("grp") == "UserContestSeries") & F.col("id").isNotNull())


def search(spark: SparkSession, text: str) -> DataFrame:
    """label, value of contests whose id holds the text or whose name does in any case; a last
    row offers the text itself unless it is blank."""
    text = text.strip()
    hit = F.col("id").cast("string").contains(text) | F.lower("name").contains(text.lower())
    found = contests(spark).where(hit).select(F.format_string("[%s] %d", "name", "id").alias("label"), F.col("id").cast("string").alias("value"))
    if not text:
        return found
    return found.unionByName(spark.createDataFrame([(f"Use custom: {text}", text)], "label string, value string"))
