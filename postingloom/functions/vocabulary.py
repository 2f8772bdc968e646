"""The word lists and lookup tables that decide the results.

Changing any of them changes what the warehouse contains, so they are kept
together here and nowhere else.
"""

# Feed names as they are stored in the ``source`` column.
SOURCE_A = "remotive"
SOURCE_B = "adzuna"

# Search terms of feed A, in request order (a later term wins over an earlier).
SOURCE_A_TERMS = [
    "data engineer", "data analyst", "data scientist",
    "analytics engineer", "business intelligence", "bi analyst",
    "data architect", "etl developer", "data engineering",
]

# Countries and search terms of feed B, in request order.
SOURCE_B_COUNTRIES = ["ch", "fr", "de", "es", "it", "nl", "at", "be", "gb", "au"]
SOURCE_B_TERMS = ["data engineer", "data analyst"]

# Work mode, tested in this order.
ON_SITE_WORDS = ["no remote", "on-site only", "not remote", "office-based only"]
HYBRID_WORDS = ["hybrid"]
REMOTE_WORDS = ["remote", "work from home", "fully distributed"]

# Titles dropped from feed A while extracting.
NOISE_WORDS = ["devops", "sre"]

# Titles that make a posting relevant, and titles that rule it out.
ROLE_WORDS = [
    "data engineer", "data analyst", "analytics engineer",
    "bi analyst", "business intelligence",
]
OFF_TOPIC_WORDS = [
    "sales", "copywriter", "writer", "marketing",
    "support", "developer", "devops", "sre",
]

# Skills, in the order in which they are reported.
SKILLS = [
    "python", "sql", "talend", "docker", "airflow", "excel", "power bi",
    "tableau", "aws", "azure", "gcp", "spark", "dbt", "snowflake",
    "etl", "postgresql", "mysql", "nosql", "mongodb", "kafka", "looker",
]

# Seniority, senior tested first. Some entries need their trailing blank.
SENIOR_WORDS = ["senior", "sr.", "sr ", "lead", "principal", "head of", "staff"]
JUNIOR_WORDS = ["junior", "jr.", "jr ", "entry level", "graduate", "intern"]

# Country code to country name.
COUNTRY_NAMES = {
    "ch": "Switzerland", "fr": "France", "de": "Germany", "es": "Spain",
    "it": "Italy", "nl": "Netherlands", "at": "Austria", "be": "Belgium",
    "gb": "United Kingdom", "au": "Australia",
}

# Placeholders.
UNKNOWN_COMPANY = "Unknown"
NO_COUNTRY_LABEL = "Remote / Not specified"
NO_CITY_LABEL = "Not specified"
