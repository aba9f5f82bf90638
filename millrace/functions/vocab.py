"""Word lists and constants whose exact content decides results."""

# Months of the credit tables, in order of time.
MONTHS = ["apr", "may", "jun", "jul", "aug", "sep"]

# Codes of the credit categories.
SEX_CODES = {"male": 1, "female": 0}
EDUCATION_CODES = {"others": 0, "high school": 1, "university": 2, "graduate school": 3}
STATUS_CODES = {"single": 0, "married": 1, "others": 2}
DEFAULT_CODES = {"no": 0, "yes": 1}
# (sex, status) -> sex_status; any other pair is 0.
SEX_STATUS_CODES = {(1, 1): 1, (1, 0): 2, (1, 2): 3, (0, 1): 4, (0, 0): 5, (0, 2): 6}
YOUNGEST_VALID_AGE = 21

# Payment delay bands.
PAY_DULY = "pay_duly"
PAY_LATE_ONE = "pay_delay_1_month"
PAY_LATE_MORE = "pay_delay_more_than_2_month"

# Rating names by tone; a name not listed is neutral.
RATING_TONES = {
    "positive": [
        "Fascinating", "Informative", "Persuasive", "Inspiring", "Courageous", "Funny",
        "Ingenious", "Jaw-dropping", "Beautiful",
    ],
    "negative": ["Longwinded", "Unconvincing", "Obnoxious", "Confusing"],
    "neutral": ["OK"],
}
FUNNY_RATING_ID = 7
LAUGH_WORD = "Laughter"

# Years of the interest tables.
TREND_YEARS = [str(y) for y in range(2006, 2018)]

# Separators between occupations; the last branch is two or more blanks.
OCCUPATION_SEPARATORS = "; |, |/| and | + "

# Occupations named in full, by group.
OCCUPATION_GROUPS = {
    "Literature": [
        "Writer", "Journalist", "Author", "Philosopher", "Historian", "Poet", "Novelist",
        "Reporter", "Writer, activist", "Performance poet, multimedia artist", "Science writer",
    ],
    "Art": [
        "Designer", "Chef", "Violinist", "Producer", "Cartoonist",
        "Performance poet, multimedia artist", "Photojournalist", "Singer-songwriter", "Artist",
        "Architect", "Photographer", "Filmmaker", "Musician", "Singer/songwriter",
        "Graphic designer", "Techno-illusionist", "Comedian", "Musician, activist", "Sculptor",
    ],
    "Economy_Politics": [
        "Entrepreneur", "Environmentalist, futurist",
        "Investor and advocate for moral leadership", "Musician, activist", "Economist",
        "Activist", "Philanthropist", "Behavioral economist", "Writer, activist",
        "Climate advocate", "Legal activist", "Futurist", "Social entrepreneur",
    ],
    "Medicine": [
        "Psychologist", "Neuroscientist", "Global health expert; data visionary",
        "Social psychologist", "Surgeon", "Physician",
    ],
    "Academy": ["Educator"],
    "Engineering_Science": [
        "Roboticist", "Biologist", "Physicist", "Marine biologist", "Technologist",
        "Global health expert; data visionary", "Astronomer", "Oceanographer", "Engineer",
        "Computer scientist", "Inventor", "Futurist", "Mathematician", "Astrophysicist",
        "Evolutionary biologist", "Sound consultant", "Game designer", "Chemist",
        "Social Media Theorist", "Data scientist", "Tech visionary", "Paleontologist",
        "Researcher",
    ],
}
OTHER_OCCUPATIONS = "Other_Occupations"

# Parts of words that place an occupation not named in full.
OCCUPATION_KEYWORDS = {
    "Literature": [
        "Author", "Historian", "Philosopher", "writer", "journ", "story", "novel",
    ],
    "Art": [
        "Actor", "composer", "Pianist", "artist", "music", "design", "art", "band", "photo",
        "arch", "visual",
    ],
    "Economy_Politics": [
        "Activist", "Marketing", "Public", "fund", "founder", "Mayor", "President", "capital",
        "entrepreneur", "religi", "futur", "explorer", "law", "Global", "advocate", "company",
    ],
    "Medicine": ["psycho", "care"],
    "Academy": ["educat", "professor"],
    "Engineering_Science": [
        "researcher", "Robotics", "engineer", "logist", "computer", "expert", "Industrial",
        "scientist", "specialist", "physicist", "bio", "tech", "math", "cyber", "digit",
        "genetic", "chem", "innov", "analy",
    ],
}

# Years of the main event, and parts of event names by group.
MAIN_EVENT_YEARS = [1984, 1990, 1994, 1998, *range(2001, 2018)]
EVENT_KEYWORDS = {
    "TEDx": ["TEDx"],
    "TED": ["TED@"],
    "TED_Global": ["TEDGlobal"],
    "TED_Other": [
        "TED D", "TED F", "TED P", "TED R", "TED S", "TED T", "TED i", "TEDD", "TEDE", "TEDF",
        "TEDG", "TEDH", "TEDI", "TEDJ", "TEDK", "TEDL", "TEDM", "TEDN", "TEDO", "TEDP", "TEDQ",
        "TEDR", "TEDS", "TEDT", "TEDU", "TEDV", "TEDW", "TEDY", "TEDZ", "TED-E",
    ],
    "Non_TED_University": [" University"],
}
OTHER_EVENTS = "Non_TED_Other"

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
