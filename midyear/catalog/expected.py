"""Fixed values as the SQL of the checks states them, apart from those the library uses."""

# Infant age groups with their lower bounds.
INFANT_THRESHOLDS = [
    ("0-27 days", "days", 28),
    ("28 days-<3 month", "months", 3),
    ("3-5 months", "months", 6),
    ("6-8 months", "months", 9),
    ("9-11 months", "months", 12),
]
INFANT_MONTHS = {
    "0-27 days": 1, "28 days-<3 month": 2, "3-5 months": 3, "6-8 months": 3, "9-11 months": 3,
}
DEPARTMENTS = {"6": "Santa Rosa", "9": "Quetzaltenango"}

# Groups of single years, base groups, and the bands each base group belongs to.
AGE_TO_GROUP = {1: "12-23 months", 2: "24-35 months", 3: "36-47 months", 4: "48-59 months"}
BASE_GROUPS = [
    "0-27 days", "28 days-<3 month", "3-5 months", "6-8 months", "9-11 months",
    "12-23 months", "24-35 months", "36-47 months", "48-59 months",
]
BANDS = {
    "0-11 months": ["0-27 days", "28 days-<3 month", "3-5 months", "6-8 months", "9-11 months"],
    "0-59 months": ["0-27 days", "28 days-<3 month", "3-5 months", "6-8 months", "9-11 months",
                    "12-23 months", "24-35 months", "36-47 months", "48-59 months"],
    "12-59 months": ["12-23 months", "24-35 months", "36-47 months", "48-59 months"],
    "24-59 months": ["24-35 months", "36-47 months", "48-59 months"],
    "0-5 months": ["0-27 days", "28 days-<3 month", "3-5 months"],
    "6-11 months": ["6-8 months", "9-11 months"],
}

# Labels of the record codes.
SEX = {"1": "male", "2": "female"}
BIRTH_TYPE = {"1": "simple", "2": "double", "3": "triple", "4": "multiple"}
DELIVERY = {"1": "Cesarean", "2": "Vaginal"}
GROUP = {"1": "Maya", "2": "Garífuna", "3": "Xinka", "4": "Mestizo / Ladino", "5": "Other", "9": "Ignored"}
ASSISTANCE = {
    "1": "Medic", "2": "Paramedic", "3": "Midwife", "4": "Empiric", "5": "None", "9": "Ignored",
}
DEATH_SITE = {
    "1": "Hospital, public", "2": "Hospital, private", "3": "Health center", "4": "Social security",
    "5": "Public way", "6": "Household", "7": "Place of work", "8": "Other", "9": "Ignored",
}
CERTIFIER = {"1": "Medic", "2": "Paramedic", "3": "Authority", "9": "Ignored"}
