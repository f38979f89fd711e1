"""Place lookup: city -> département of the Paris region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.functions.text import slug

# Commune slugs of the reference list, by département code.
DEPT = {
    "75": ["paris"],
    "92": [
        "nanterre", "montrouge", "boulogne-billancourt", "puteaux", "courbevoie",
        "issy-les-moulineaux", "levallois-perret", "neuilly-sur-seine", "clichy",
        "suresnes", "rueil-malmaison", "colombes", "asnieres-sur-seine", "bois-colombes",
        "gennevilliers", "clamart", "meudon", "antony", "bagneux", "chatillon", "sevres",
        "vanves", "la-garenne-colombes", "saint-cloud", "malakoff", "fontenay-aux-roses",
        "sceaux", "le-plessis-robinson", "chatenay-malabry", "bourg-la-reine", "garches",
        "chaville", "vaucresson",
    ],
    "93": [
        "saint-denis", "saint-ouen", "saint-ouen-sur-seine", "aubervilliers", "pantin",
        "montreuil", "bobigny", "noisy-le-grand", "rosny-sous-bois", "bagnolet",
        "le-bourget", "la-courneuve", "drancy", "aulnay-sous-bois", "epinay-sur-seine",
        "stains", "villepinte", "tremblay-en-france", "livry-gargan", "sevran",
        "romainville", "les-lilas", "noisy-le-sec", "le-blanc-mesnil", "bondy", "dugny",
    ],
    "94": [
        "creteil", "ivry-sur-seine", "vitry-sur-seine", "charenton-le-pont",
        "saint-maur-des-fosses", "vincennes", "fontenay-sous-bois", "maisons-alfort",
        "alfortville", "villejuif", "le-kremlin-bicetre", "kremlin-bicetre", "cachan",
        "arcueil", "gentilly", "rungis", "orly", "choisy-le-roi", "thiais",
        "nogent-sur-marne", "champigny-sur-marne", "fresnes", "chevilly-larue",
        "saint-mande", "bry-sur-marne", "joinville-le-pont",
    ],
    "78": [
        "versailles", "saint-quentin-en-yvelines", "montigny-le-bretonneux", "guyancourt",
        "velizy-villacoublay", "velizy", "poissy", "sartrouville", "mantes-la-jolie",
        "les-mureaux", "plaisir", "trappes", "elancourt", "rambouillet", "le-chesnay",
        "saint-germain-en-laye", "conflans-sainte-honorine", "chatou", "houilles",
        "carrieres-sur-seine", "buc", "voisins-le-bretonneux",
    ],
    "91": [
        "evry", "evry-courcouronnes", "massy", "palaiseau", "corbeil-essonnes",
        "savigny-sur-orge", "sainte-genevieve-des-bois", "viry-chatillon", "athis-mons",
        "les-ulis", "orsay", "gif-sur-yvette", "draveil", "longjumeau", "montgeron",
        "wissous", "saclay", "ris-orangis", "bretigny-sur-orge",
    ],
    "95": [
        "cergy", "pontoise", "argenteuil", "sarcelles", "garges-les-gonesse",
        "franconville", "ermont", "goussainville", "roissy-en-france", "roissy", "gonesse",
        "eaubonne", "herblay", "taverny", "montmorency", "osny", "bezons",
        "cormeilles-en-parisis", "sannois", "domont",
    ],
    "77": [
        "meaux", "melun", "chelles", "champs-sur-marne", "torcy", "pontault-combault",
        "savigny-le-temple", "bussy-saint-georges", "serris", "noisiel",
        "marne-la-vallee", "combs-la-ville", "roissy-en-brie", "villeparisis",
        "mitry-mory", "lieusaint", "lagny-sur-marne",
    ],
}
# The region pseudo-commune and its code; the two fallbacks.
REGION_SLUG = "ile-de-france"
REGION_CODE = "IDF"
OUTSIDE = "Hors référentiel"
UNSPECIFIED = "Non précisé"


def reference_rows() -> list[tuple[str, str]]:
    rows = [(c, d) for d, cities in DEPT.items() for c in cities]
    known = {c for c, _ in rows}
    if REGION_SLUG not in known:
        rows.append((REGION_SLUG, REGION_CODE))
    return rows


def reference_df(spark: SparkSession) -> DataFrame:
    """The commune reference as a small DataFrame (fixed size: 165 rows)."""
    return spark.createDataFrame(reference_rows(), "geo_slug string, geo_dept string")


def with_departement(df: DataFrame, city: str | Column, ref: DataFrame | None = None,
                     dept_col: str = "departement", idf_col: str = "is_idf") -> DataFrame:
    """Add the département code and the in-region flag for ``city``.

    The reference has a fixed, known size, so it is broadcast: the lookup is a
    map-side hash join with no shuffle of ``df``.
    """
    ref = ref if ref is not None else reference_df(df.sparkSession)
    c = F.col(city) if isinstance(city, str) else city
    tmp = "__geo_slug"
    out = df.withColumn(tmp, slug(c)).join(F.broadcast(ref), F.col(tmp) == F.col("geo_slug"), "left")
    dept = (F.when(F.col("geo_dept").isNotNull(), F.col("geo_dept"))
            .when(F.col(tmp) != "", F.lit(OUTSIDE))
            .otherwise(F.lit(UNSPECIFIED)))
    return (out.withColumn(dept_col, dept)
               .withColumn(idf_col, F.col("geo_dept").isNotNull())
               .drop(tmp, "geo_slug", "geo_dept"))
