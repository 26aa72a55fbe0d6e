"""Names, lists and sizes that results depend on.

Everything here is a constant that has to stay exactly as it is for queries to
return the expected rows.  There is no logic in this module.
"""

# Columns tried, in this order, when a table does not say which one is its date axis.
DATE_COLUMN_CANDIDATES = ("date", "time_frame", "open_date", "awarded_date", "start_date")

# Columns that hold geometry: WKT text or WKB bytes.
GEOMETRY_COLUMNS = ("geometry_wkt", "geometry")

# Layouts whose rows are already their natural grain and are never reshaped.
UNRESHAPABLE_LAYOUTS = ("feature", "entity")

# Table-level metadata fields; anything else in a description is not table metadata.
TABLE_META_KEYS = (
    "name", "namespace", "source", "country", "title", "description",
    "bulk_export_class", "geometry_type", "has_geometry", "row_count_at_last_refresh",
    "attribution_text", "licence", "source_url", "cdc_serving_tier", "pk_columns",
    "current_snapshot_id", "refresh_cadence", "observation_frequency", "last_refreshed_at",
    "previous_snapshots", "date_filter_column", "layout", "time_columns", "id_columns",
    "value_columns", "measure_name_column",
)

# Metadata fields that a provenance record may override.
PROVENANCE_KEYS = ("attribution_text", "licence", "source", "source_url", "namespace")

# Fields of a compact search hit.
SEARCH_HIT_COLUMNS = ("name", "title", "source", "namespace")

# Short words analysts use, and the phrases each stands for.
SEARCH_ALIASES = {
    "hlfs": ("hlfs", "household labour", "labour force survey", "labour force",
             "labour market", "unemployment rate"),
    "ocr": ("ocr", "official cash rate", "cash rate"),
    "cpi": ("cpi", "consumer price", "inflation", "prices"),
    "kapiti": ("kapiti", "kcdc_", "kapiti coast"),
    "porirua": ("porirua", "pcc_"),
}

# Aliases that look at name and title only.
NAME_ONLY_ALIASES = ("hlfs", "kapiti", "porirua")

# Datasets listed first for an alias (lower first); all others get UNRANKED.
SEARCH_RANKS = {
    "cpi": {"rbnz_m1_prices": 0, "rbnz_m1_prices_longrun": 1, "nz_cpi": 2},
    "hlfs": {"nz_unemployment": 0, "rbnz_m9_labour_market": 1, "poppr_lab_national": 2,
             "poppr_lab_national_chars": 3},
}
UNRANKED = 99

# Short publisher names and the source label each one stands for.
PUBLISHERS = {
    "acc": "ACC",
    "akl_council": "Auckland Council",
    "akl_transport": "Auckland Transport",
    "bay_of_plenty": "Bay of Plenty Councils",
    "charities": "Charities Services",
    "colab_waikato": "Co-Lab Waikato",
    "doc": "DOC",
    "ecan_canterbury": "ECan / Canterbury",
    "edcounts": "Education Counts",
    "eeca": "EECA",
    "geonet": "GeoNet",
    "hawkes_bay": "Hawke's Bay Councils",
    "immigration": "Immigration NZ",
    "linz": "LINZ",
    "lris": "Manaaki Whenua / LRIS",
    "manawatu_whanganui": "Manawatu-Whanganui Councils",
    "mbie": "MBIE",
    "msd": "MSD",
    "napier_whanganui": "Napier + Whanganui",
    "northland": "Northland Councils",
    "nzta": "Waka Kotahi",
    "oecd": "OECD",
    "otago": "Otago Councils",
    "pharmac": "PHARMAC",
    "police": "NZ Police / MoJ",
    "rbnz": "RBNZ",
    "southland": "Southland Councils",
    "statsnz": "Stats NZ",
    "statsnz_geo": "Stats NZ",
    "taranaki": "Taranaki Councils",
    "top_of_south": "Gisborne / Top of South Councils",
    "treasury": "NZ Treasury",
    "wellington": "Wellington Region Councils",
    "west_coast": "West Coast (Te Tai o Poutini)",
    "worksafe": "WorkSafe NZ",
}

# Sizes.
FEED_PAGE_ROWS = 50_000
LARGE_TABLE_ROWS = 100_000
EXPORT_ROW_CEILING = 500
SEARCH_HIT_CEILING = 50
PREVIEW_ROWS = 10
