"""Rule tables and the labels they give: sectors, confidence, name quality, junk.

Every table is a parameter with a default. Labels are decided by order, first match
first, in one expression per label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklore.functions.text import contains_any, first_rule, is_unknown, lookup, norm_brand, strip

#: Words of an industrial name (fixed values).
INDUSTRIAL = (
    "grain elevator terminal warehouse storage depot mill plant factory refinery chemical lumber concrete cement aggregate sand gravel stone coal mine quarry "
    "steel metal iron scrap oil gas petroleum fuel propane ethanol feed seed fertilizer coop co-op cooperative food beverage brewery sugar flour dairy paper pulp "
    "wood timber forest products auto truck vehicle railroad railway rail logistics distribution freight transport intermodal industrial manufacturing processing "
    "materials energy power electric utility silo tank"
).split()
#: Sectors by words of the name, in order (fixed values).
SECTORS = {
    "Agriculture": "grain elevator feed seed farm coop co-op cooperative ethanol fertilizer agri silo".split(),
    "Chemicals": "chemical chem polymer plastic resin".split(),
    "Energy": "energy oil gas petroleum fuel propane pipeline power electric utility".split(),
    "Metals": "steel metal iron aluminum foundry forge scrap".split(),
    "Building Materials": "lumber concrete cement aggregate sand gravel stone brick".split(),
    "Forest Products": "paper pulp wood lumber timber".split(),
    "Food & Beverage": "food beverage brewery sugar flour meat dairy".split(),
    "Mining": "mine mining mineral coal quarry".split(),
    "Logistics": "logistics warehouse distribution freight transport terminal intermodal depot storage".split(),
}
#: Sectors of the place source: another word set, and vehicles before logistics (fixed values).
PLACE_SECTORS = {
    "Agriculture": "grain elevator feed seed farm coop ethanol fertilizer agri".split(),
    "Chemicals": SECTORS["Chemicals"],
    "Energy": "energy oil gas petroleum fuel propane pipeline".split(),
    "Metals": SECTORS["Metals"],
    "Building Materials": SECTORS["Building Materials"],
    "Forest Products": SECTORS["Forest Products"],
    "Food & Beverage": SECTORS["Food & Beverage"],
    "Mining": SECTORS["Mining"],
    "Automotive": "auto automotive vehicle car truck".split(),
    "Logistics": "logistics warehouse distribution freight transport terminal intermodal".split(),
}
#: Sectors by place category (fixed values).
CATEGORY_SECTORS = {
    c: s
    for s, cs in {
        "Manufacturing": "manufacturing_facility factory industrial_facility industrial_estate workshop",
        "Metals": "fabrication steel_mill metal_fabrication foundry",
        "Logistics": "warehouse distribution_center freight_terminal logistics_facility storage_facility loading_dock intermodal_terminal cargo_terminal wholesale wholesale_store trade_supplier",
        "Mining": "mine quarry stone_quarry gravel_pit",
        "Energy": "coal_plant oil_and_gas refinery power_plant natural_gas_facility petroleum_facility fuel_depot propane_supplier",
        "Agriculture": "grain_elevator feed_mill silo farm agricultural_facility fertilizer_plant ethanol_plant dairy_facility",
        "Food & Beverage": "sugar_mill flour_mill food_processing",
        "Forest Products": "lumber_yard",
        "Building Materials": "cement_plant concrete_plant aggregate_supplier building_supply hardware_store",
        "Waste/Recycling": "scrap_metal recycling_facility",
        "Chemicals": "chemical_plant chemical_facility",
        "Water/Utilities": "water_treatment wastewater_treatment pumping_station water_works electric_utility substation",
        "Automotive": "auto_parts car_dealership car_manufacturing auto_manufacturing",
        "Rail Services": "railway_station train_station rail_yard",
    }.items()
    for c in cs.split()
}
#: Place categories of rail-served industry: those with a freight sector (rule over the table above).
RAIL_CATEGORIES = sorted(c for c, s in CATEGORY_SECTORS.items() if s not in ("Water/Utilities", "Automotive", "Rail Services"))
#: Words of a place's name, and types, that speak for and against industry (fixed values).
PLACE_WORDS = "warehouse storage industrial manufacturing factory plant terminal depot yard elevator mill refinery chemical".split()
PLACE_TYPES = ["industrial", "storage", "warehouse"]
OTHER_TYPES = (
    "church school hospital doctor dentist park cemetery library museum restaurant cafe bar lodging hotel real_estate_agency beauty_salon hair_care spa gym laundry "
    "atm bank insurance_agency lawyer pharmacy veterinary_care pet_store florist clothing_store"
).split()
#: Words of thoroughfares and landforms (fixed values).
GEO_WORDS = (
    "road|rd|street|st|avenue|ave|blvd|boulevard|highway|hwy|lane|ln|drive|dr|court|ct|place|pl|way|route|rte|pike|pkwy|parkway|trail|path|crossing|junction|jct|"
    "bridge|creek|river|lake|pond|bay|island|mountain|mt|hill|valley|hollow|holler|run"
)


def sector_by_name(name: Column, table: dict[str, list[str]] | None = None) -> Column:
    return first_rule(F.lower(F.coalesce(name, F.lit(""))), SECTORS if table is None else table)


def sector_by_words(name: Column, kind: Column, table: dict[str, list[str]]) -> Column:
    """First sector of a larger table with a word in name and kind together; nulls read ``nan``."""
    text = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("nan")), F.coalesce(kind, F.lit("nan"))))
    return first_rule(text, table)


def sector_by_category(kind: Column, table: dict[str, str] | None = None) -> Column:
    return lookup(F.replace(strip(F.lower(kind)), F.lit(" "), F.lit("_")), CATEGORY_SECTORS if table is None else table)


def layered_sector(known: Column, *layers: Column) -> Column:
    """The known sector unless it is unknown, else the first layer that has one."""
    return F.coalesce(F.when(~is_unknown(known), known), *(F.nullif(x, F.lit("")) for x in layers), F.lit(""))


def is_industrial(name: Column) -> Column:
    return contains_any(F.lower(F.coalesce(name, F.lit(""))), INDUSTRIAL)


def is_rail_category(category: Column) -> Column:
    return F.coalesce(F.lower(category).isin(RAIL_CATEGORIES), F.lit(False))


def place_is_usable(name: Column, category: Column, lat: Column, lon: Column) -> Column:
    """A position that is not zero, and an industrial category or name."""
    return F.coalesce((lat != 0) & (lon != 0), F.lit(False)) & (is_rail_category(category) | is_industrial(name))


def category_text(category: Column) -> Column:
    return F.coalesce(F.replace(F.nullif(category, F.lit("")), F.lit("_"), F.lit(" ")), F.lit("overture_poi"))


def overture_confidence(name: Column, category: Column) -> Column:
    return F.when(is_industrial(name) | is_rail_category(category), "HIGH").otherwise("MEDIUM")


def _tag(tags: Column, key: str) -> Column:
    return F.coalesce(tags[key], F.lit(""))


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols), F.lit(""))


def poi_name(tags: Column) -> Column:
    return first_filled(tags["name"], tags["operator"], tags["brand"])


def poi_confidence(tags: Column) -> Column:
    return F.when(is_industrial(poi_name(tags)) | (_tag(tags, "man_made") != "") | _tag(tags, "building").isin("industrial", "warehouse"), "HIGH").otherwise("MEDIUM")


def poi_kind(tags: Column) -> Column:
    return first_filled(tags["man_made"], tags["building"], tags["landuse"], F.lit("poi"))


def feature_class(tags: Column) -> Column:
    """struct<confidence,kind> of a map feature; commercial buildings count as industrial here."""
    b, land, man = _tag(tags, "building"), _tag(tags, "landuse"), _tag(tags, "man_made")
    words = contains_any(F.lower(_tag(tags, "name")), [w for w in INDUSTRIAL if w not in ("silo", "tank")])
    pair = lambda c, k: F.struct(F.lit(c).alias("confidence"), k.alias("kind"))
    return (
        F.when(words | man.isin("works", "silo", "storage_tank", "kiln"), pair("HIGH", first_filled(man, b, land, F.lit("industrial"))))
        .when(b.isin("industrial", "warehouse", "commercial") | (land == "industrial"), pair("HIGH", first_filled(b, land)))
        .when(b != "", pair("MEDIUM", b))
        .otherwise(pair("MEDIUM", F.lit("poi")))
    )


def place_confidence(name: Column, types: Column, spur_name: Column) -> Column:
    n = F.lower(F.coalesce(name, F.lit("")))
    has = lambda t: F.coalesce(F.arrays_overlap(types, F.array(*(F.lit(x) for x in t))), F.lit(False))
    named = contains_any(n, PLACE_WORDS)
    spur = F.lower(F.coalesce(spur_name, F.lit("")))
    return F.when(has(OTHER_TYPES) & ~named, "LOW").when(has(PLACE_TYPES) | named, "HIGH").when((spur != "") & F.contains(n, spur), "HIGH").otherwise("MEDIUM")


def name_class(name: Column) -> Column:
    """empty, numeric, trivial, osm_tag, geo_keyword or real, first match first."""
    s = strip(F.coalesce(name, F.lit("")))
    return (
        F.when(s == "", "empty")
        .when(s.rlike(r"^-?\d+(?:\.\d+)?(?:,\s*-?\d+(?:\.\d+)?)?$"), "numeric")
        .when(s.rlike(r"^\d+$|^.{0,2}$"), "trivial")
        .when(s.rlike(r"(?i)^(?:node|way|relation)\s*\d+"), "osm_tag")
        .when(s.rlike(rf"(?iU)\b(?:{GEO_WORDS})\b"), "geo_keyword")
        .otherwise("real")
    )


def name_quality(name: Column) -> Column:
    c = name_class(name)
    return F.when(c == "empty", "empty_name").when(c == "real", "real").otherwise("low_quality_name")


def data_quality(name: Column, city: Column, state: Column) -> Column:
    """low_quality_name, no_location (town or state is blank) or complete; an empty name is not tested."""
    nowhere = (strip(F.coalesce(city, F.lit(""))) == "") | (strip(F.coalesce(state, F.lit(""))) == "")
    return F.when(name_quality(name) == "low_quality_name", "low_quality_name").when(nowhere, "no_location").otherwise("complete")


def facility_value(kind: Column) -> Column:
    return F.when(kind.isin("yes", "roof"), "building").when(kind == "poi", "point_of_interest").otherwise(kind)


def in_list(name: Column, names: list[str]) -> Column:
    """Exact membership of the stripped lower-case name in a list of brands."""
    return F.coalesce(strip(F.lower(name)).isin(names), F.lit(False))


def excluded_by_words(name: Column, words: str, unless: str) -> Column:
    """A hit of one pattern and none of the other; both are parameters."""
    n = F.coalesce(name, F.lit(""))
    return n.rlike("(?iU)" + words) & ~n.rlike("(?iU)" + unless)


def business_label(name: Column, brands: dict[str, list[str]], words: str, lodging: str, unless: str) -> Column:
    """Category of a name that is no shipper: a bare brand, then a pattern, with lodging apart; '' if none.

    ``unless`` redeems a lodging name. All tables are parameters: they are rules of
    a business and not of the engine.
    """
    n = F.coalesce(name, F.lit(""))
    bare = norm_brand(name)
    out = F.when(F.lit(False), "")
    for label, names in brands.items():
        out = out.when(bare.isin(names), label)
    hit, lodge, redeemed = n.rlike("(?iU)" + words), n.rlike("(?iU)" + lodging), n.rlike("(?iU)" + unless)
    return out.when(hit & lodge & ~redeemed, "accommodation").when(hit & ~lodge, "keyword_pattern").otherwise("")


#: Words that keep any name from being junk (fixed values).
SAFE_WORDS = (
    "chemicals?|plants?|refinery|refineries|terminal|warehouse|mills?|factory|foundry|smelter|forge|elevator|ethanol|fertilizer|steel|lumber|paper|pulp|cement|concrete|aggregate|petroleum|"
    "pipeline|storage|logistics|freight|recycling|scrap|grain|coal|power|generating|substation|products?|materials?|supply|industries|industry|manufacturing|processing|services?|solutions?|"
    "systems?|technologies|technology|enterprises?|holdings?|group|international|america|corporation|inc|llc|corp|co"
)
#: Short names of real firms, generic words, and words of streets and districts (fixed values).
SHORT_FIRMS = ["3M", "BP", "GE", "CF", "DX", "UPS", "CSX", "CN", "CP", "NS", "UP"]
GENERIC = r"north|south|east|west|northeast|northwest|southeast|southwest|the|a|an|unknown|unnamed|unnamed\s+facility|fixme|n\s*/\s*a|null|none|tbd"
STREETS = (
    "street|st|avenue|ave|boulevard|blvd|road|rd|drive|dr|lane|ln|way|place|pl|court|ct|circle|cir|trail|trl|parkway|pkwy|terrace|ter|pike|turnpike|highway|hwy|freeway|fwy|"
    "expressway|throughway|thruway|causeway|connector|bypass|cutoff"
)
DISTRICTS = "county|parish|township|twp|borough|boro|municipality|precinct"
#: Designations of numbered roads by what may stand before the number: any dash or number sign, a dash, blanks; states by their two letters (fixed values).
ROADS_SIGN = r"US|U\.S\.|State\s+(?:Route|Highway|Road)|SR|SH|FM|RM|Ranch\s+(?:to\s+Market|Road)|Farm\s+(?:to\s+Market|Road)"
ROADS_BLANK = "Interstate|Highway|Hwy|Route|RT|RTE"
STATES = "NY|CA|TX|OH|IL|PA|GA|FL|WI|MN|IA|KS|MO|AR|LA|MS|AL|TN|KY|IN|MI|NC|SC|VA|WV|MD|DE|NJ|CT|MA|RI|NH|VT|ME|ND|SD|NE|CO|UT|AZ|NM|NV|ID|MT|WY|OR|WA|AK|HI|OK|M"


def junk_reason(name: Column) -> Column:
    """Why a name is no firm: empty, number, short, generic, highway, street, district; '' if it may be one.

    A word of industry or business in the name keeps it.
    """
    s = strip(F.coalesce(name, F.lit("")))
    m = lambda p: s.rlike("(?iU)^(?:" + p + ")$")
    tail = r"[\w\s\-\.;]*"
    road = "|".join(
        (
            rf"(?:{ROADS_SIGN})\s*[-#]?\s*\d+{tail}",
            rf"(?:I|{STATES})\s*-?\s*\d+{tail}",
            rf"(?:{ROADS_BLANK})\s+\d+{tail}",
            r"(?:US|I-|SR|FM|CR|RM|Highway|Hwy)\s*\d[\w\s\-]*(?:;\s*(?:US|I-|SR|SH|FM|CR|RM|[A-Z]{2})\s*-?\s*\d[\w\s\-]*)+",
            r"(?:County\s+(?:Road|Route|Highway)|CR)\s*[-#]?\s*[A-Z0-9][\w\.\-;]*",
            r"(?:Business|Loop|Spur|Alt|Alternate|Business\s+Loop)\s+(?:US|I|Highway|Hwy|Route)\s*[-#]?\s*\d+.*",
            r"(?:Truck\s+Route|Access\s+Road\s*[A-Z0-9]*|Service\s+Road)\s*\d*",
        )
    )
    return (
        F.when(s == "", "empty")
        .when(s.rlike(rf"(?iU)\b(?:{SAFE_WORDS})\b"), "")
        .when(m(r"\d+(?:\.\d+)?"), "number")
        .when((F.length(s) <= 2) & ~F.upper(s).isin(SHORT_FIRMS), "short")
        .when(m(GENERIC), "generic")
        .when(m(road), "highway")
        .when(m(rf"\d+(?:st|nd|rd|th)\s+(?:street|ave|avenue|road|drive|blvd|boulevard|place|lane|way|court)|(?:\d+\s+)?[\w\s\-'\.]+\s+(?:{STREETS})"), "street")
        .when(m(rf"[\w\s\-'\.]+\s+(?:{DISTRICTS})"), "district")
        .otherwise("")
    )
