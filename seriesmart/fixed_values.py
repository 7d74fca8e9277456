"""Names, labels and codes that must equal the published ones.

Everything here is data, kept together and in natural order. Nothing in this
module grows with the input, so tables built from it are safe to broadcast.
"""

# --- Fixed values: cities -------------------------------------------------
# (city, province or composite, city code); the last row is the nation.
CITIES = [
    ("Calgary", "Alberta", "825"),
    ("Charlottetown", "Prince Edward Island", "105"),
    ("Edmonton", "Alberta", "835"),
    ("Halifax", "Nova Scotia", "205"),
    ("Montreal", "Quebec", "462"),
    ("Ottawa-Gatineau", "Ontario/Quebec", "505"),
    ("Quebec City", "Quebec", "421"),
    ("Regina", "Saskatchewan", "705"),
    ("Saint John", "New Brunswick", "310"),
    ("Saskatoon", "Saskatchewan", "725"),
    ("St. John's", "Newfoundland and Labrador", "001"),
    ("Thunder Bay", "Ontario", "595"),
    ("Toronto", "Ontario", "535"),
    ("Vancouver", "British Columbia", "933"),
    ("Victoria", "British Columbia", "935"),
    ("Winnipeg", "Manitoba", "602"),
    ("Canada", "Canada", "000"),
]

# --- Fixed values: spellings each source uses for a city -------------------
CITY_SPELLINGS = {
    "Calgary": ["Calgary", "Calgary, Alberta", "Calgary CMA"],
    "Charlottetown": [
        "Charlottetown",
        "Charlottetown-Summerside",
        "Charlottetown, Prince Edward Island",
    ],
    "Edmonton": ["Edmonton", "Edmonton, Alberta", "Edmonton CMA"],
    "Halifax": ["Halifax", "Halifax, Nova Scotia"],
    "Montreal": ["Montréal", "Montreal", "Montréal, Quebec", "Montreal CMA"],
    "Ottawa-Gatineau": [
        "Ottawa",
        "Ottawa-Gatineau",
        "Ottawa–Gatineau",
        "Ottawa - Gatineau",
        "Ottawa-Gatineau, Ontario part",
        "Ottawa-Gatineau, Ontario part, Ontario/Quebec",
    ],
    "Quebec City": ["Québec", "Quebec City", "Quebec - CMA", "Québec, Quebec"],
    "Regina": ["Regina", "Regina, Saskatchewan"],
    "Saint John": ["Saint John", "Saint John, New Brunswick"],
    "Saskatoon": ["Saskatoon", "Saskatoon, Saskatchewan"],
    "St. John's": [
        "St. John's",
        "St John's",
        "St. John's, Newfoundland and Labrador",
    ],
    "Thunder Bay": ["Thunder Bay", "Thunder Bay, Ontario"],
    "Toronto": ["Toronto", "Toronto, Ontario", "Toronto CMA"],
    "Vancouver": [
        "Vancouver",
        "Vancouver, British Columbia",
        "Vancouver CMA",
        "Metro Vancouver",
    ],
    "Victoria": ["Victoria", "Victoria, British Columbia"],
    "Winnipeg": ["Winnipeg", "Winnipeg, Manitoba"],
}

# --- Fixed values: cities a provincial figure is copied to -----------------
PROVINCE_MEMBERS = {
    "Alberta": ["Calgary", "Edmonton"],
    "British Columbia": ["Vancouver", "Victoria"],
    "Manitoba": ["Winnipeg"],
    "New Brunswick": ["Saint John"],
    "Newfoundland and Labrador": ["St. John's"],
    "Nova Scotia": ["Halifax"],
    "Ontario": ["Toronto", "Ottawa-Gatineau", "Thunder Bay"],
    "Prince Edward Island": ["Charlottetown"],
    "Quebec": ["Montreal", "Quebec City"],
    "Saskatchewan": ["Regina", "Saskatoon"],
}

# --- Fixed values: indicators ----------------------------------------------
# (indicator, source, unit, category, frequency)
INDICATORS = [
    ("CPI - All-items", "StatCan", "Index (2002=100)", "CPI", "monthly"),
    ("CPI - Food", "StatCan", "Index (2002=100)", "CPI", "monthly"),
    ("CPI - Shelter", "StatCan", "Index (2002=100)", "CPI", "monthly"),
    ("CPI - Transportation", "StatCan", "Index (2002=100)", "CPI", "monthly"),
    ("CPI - Energy", "StatCan", "Index (2002=100)", "CPI", "monthly"),
    ("Food price - Bread (per 675g)", "StatCan", "CAD", "Food", "monthly"),
    ("Food price - Milk (per 2L)", "StatCan", "CAD", "Food", "monthly"),
    ("Food price - Eggs (per dozen)", "StatCan", "CAD", "Food", "monthly"),
    ("Gasoline price (per litre)", "StatCan", "Cents/Litre", "Energy", "monthly"),
    ("NHPI - Total", "StatCan", "Index (201612=100)", "Housing", "monthly"),
    ("NHPI - House only", "StatCan", "Index (201612=100)", "Housing", "monthly"),
    ("NHPI - Land only", "StatCan", "Index (201612=100)", "Housing", "monthly"),
    ("Avg rent - Bachelor", "CMHC", "CAD/month", "Housing", "annual"),
    ("Avg rent - 1 Bedroom", "CMHC", "CAD/month", "Housing", "annual"),
    ("Avg rent - 2 Bedroom", "CMHC", "CAD/month", "Housing", "annual"),
    ("Avg rent - 3 Bedroom +", "CMHC", "CAD/month", "Housing", "annual"),
    ("Avg rent - Total", "CMHC", "CAD/month", "Housing", "annual"),
    ("Vacancy rate - Bachelor", "CMHC", "Percent", "Housing", "annual"),
    ("Vacancy rate - 1 Bedroom", "CMHC", "Percent", "Housing", "annual"),
    ("Vacancy rate - 2 Bedroom", "CMHC", "Percent", "Housing", "annual"),
    ("Vacancy rate - 3 Bedroom +", "CMHC", "Percent", "Housing", "annual"),
    ("Vacancy rate - Total", "CMHC", "Percent", "Housing", "annual"),
    ("Mortgage rate - 1 year", "CMHC", "Percent", "Mortgage", "monthly"),
    ("Mortgage rate - 3 year", "CMHC", "Percent", "Mortgage", "monthly"),
    ("Mortgage rate - 5 year", "CMHC", "Percent", "Mortgage", "monthly"),
    ("Mortgage delinquency rate", "CMHC", "Percent", "Mortgage", "quarterly"),
    ("HELOC delinquency rate", "CMHC", "Percent", "Credit", "quarterly"),
    ("Credit card delinquency rate", "CMHC", "Percent", "Credit", "quarterly"),
    ("Auto loan delinquency rate", "CMHC", "Percent", "Credit", "quarterly"),
    ("LOC delinquency rate", "CMHC", "Percent", "Credit", "quarterly"),
    ("Avg credit score - Without mortgage", "CMHC", "Score", "Credit", "quarterly"),
    ("Avg credit score - With mortgage", "CMHC", "Score", "Credit", "quarterly"),
    ("Avg credit score - With new mortgage", "CMHC", "Score", "Credit", "quarterly"),
    ("Avg monthly mortgage payment - Existing", "CMHC", "CAD/month", "Mortgage", "quarterly"),
    ("Avg monthly mortgage payment - New", "CMHC", "CAD/month", "Mortgage", "quarterly"),
]

# --- Fixed values: published labels -> indicator ---------------------------
CPI_LABELS = {
    "All-items": "CPI - All-items",
    "Food": "CPI - Food",
    "Shelter": "CPI - Shelter",
    "Transportation": "CPI - Transportation",
    "Energy": "CPI - Energy",
}
CPI_BASE = "2002=100"
FUEL_LABELS = {
    "Regular unleaded gasoline at self service filling stations": "Gasoline price (per litre)",
}
FOOD_LABELS = {
    "White bread, 675 grams": "Food price - Bread (per 675g)",
    "Milk, 2 litres": "Food price - Milk (per 2L)",
    "Eggs, 1 dozen": "Food price - Eggs (per dozen)",
}
HOUSE_PRICE_LABELS = {
    "Total (house and land)": "NHPI - Total",
    "House only": "NHPI - House only",
    "Land only": "NHPI - Land only",
}
INCOME_STATISTICS = {
    "Median income (excluding zeros)": "median_income",
    "Average income (excluding zeros)": "avg_income",
    "Number of persons with income": "num_persons",
}

# --- Fixed values: published table numbers ---------------------------------
TABLE_NUMBERS = {
    "cpi_cma": "1810000412",
    "median_income": "1110023901",
    "food_prices": "1810024501",
    "gasoline_prices": "1810000101",
    "nhpi": "1810020501",
}

# --- Fixed values: worksheet layouts (cell positions count from 0) ----------
SURVEY_FIRST_ROW = 4
SURVEY_POSITIONS = {4: "Bachelor", 6: "1 Bedroom", 8: "2 Bedroom", 10: "3 Bedroom +", 12: "Total"}
OCCUPIED_SHEET = "ARent_Vac_Occ"
OCCUPIED_FIRST_ROW = 11
OCCUPIED_POSITIONS = {4: "Bachelor", 9: "1 Bedroom", 14: "2 Bedroom", 19: "3 Bedroom +", 24: "Total"}
SURVEY_MEASURES = {"vacancy": "Vacancy rate", "rent": "Avg rent"}

RATE_SHEET = "Table K1"
RATE_FIRST_ROW = 3
RATE_POSITIONS = {2: "1 year", 3: "3 year", 4: "5 year"}
RATE_INDICATORS = {
    "1 year": "Mortgage rate - 1 year",
    "3 year": "Mortgage rate - 3 year",
    "5 year": "Mortgage rate - 5 year",
}

CREDIT_FIRST_ROW = 4
# (sheet, cell position, indicator, geography)
CREDIT_LAYOUT = [
    ("DATA_1", 1, "Mortgage delinquency rate", "Canada"),
    ("DATA_1", 2, "Mortgage delinquency rate", "Montreal"),
    ("DATA_1", 3, "Mortgage delinquency rate", "Toronto"),
    ("DATA_1", 4, "Mortgage delinquency rate", "Vancouver"),
    ("DATA_7", 2, "HELOC delinquency rate", "Canada"),
    ("DATA_7", 3, "Credit card delinquency rate", "Canada"),
    ("DATA_7", 4, "Auto loan delinquency rate", "Canada"),
    ("DATA_7", 5, "LOC delinquency rate", "Canada"),
    ("DATA_13", 1, "Avg credit score - Without mortgage", "Canada"),
    ("DATA_13", 2, "Avg credit score - With mortgage", "Canada"),
    ("DATA_13", 3, "Avg credit score - With new mortgage", "Canada"),
    ("DATA_25", 1, "Avg monthly mortgage payment - Existing", "Canada"),
    ("DATA_25", 2, "Avg monthly mortgage payment - New", "Canada"),
]
FULL_LABEL_ONLY_SHEETS = ["DATA_25"]

TENURE_SHEETS = {"All Households": "All", "Renter": "Renter", "Owner": "Owner"}
TENURE_HEADER_ROW = 8  # counted from 1
TENURE_SKIP_LABELS = ["End of worksheet", "Georgraphy", "Geography"]

# --- Fixed values: text conventions ----------------------------------------
EMPTY_MARKS = ["--", "**", ""]
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
NO_DATA = "(no data)"
TIGHT_VACANCY = 3.0
ELEVATED_DELINQUENCY = 0.5

# --- Fixed values: indicator families of the availability report ------------
# (family, title, indicator name pattern or list, month or None, suffix of the printed line)
FAMILIES = [
    ("cpi", "CPI", "CPI%", None, "monthly"),
    ("gasoline", "Gasoline prices", ["Gasoline price (per litre)"], None, "monthly"),
    ("food", "Food prices", "Food price%", None, "monthly"),
    ("rent", "Average rents", "Avg rent%", 10, "annual"),
    ("vacancy", "Vacancy rates", "Vacancy rate%", 10, "annual"),
    ("nhpi", "NHPI", "NHPI%", None, "monthly"),
    ("mortgage", "Mortgage rates", "Mortgage rate%", None, "monthly"),
    (
        "credit_trends",
        "Mortgage & credit trends",
        [
            "Mortgage delinquency rate",
            "Avg credit score - With mortgage",
            "Avg monthly mortgage payment - Existing",
        ],
        None,
        "quarterly",
    ),
]
INCOME_FAMILY = ("income", "Income", "annual")
