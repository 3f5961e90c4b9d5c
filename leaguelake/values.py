"""Labels, thresholds, lookups and contracts that results depend on."""

from __future__ import annotations

# Club name affixes (regular expressions).
CLUB_SUFFIX = " FC$"
CLUB_PREFIX = "^AFC "

WIN_POINTS = 3
DRAW_POINTS = 1

# Feed labels.
PRIMARY_SOURCE = "football-data.org"
FALLBACK_SOURCE = "thesportsdb"
TABLE_FALLBACK_SOURCE = "local-mart-fallback"
DEFAULT_COMPETITION = "Premier League"
DEFAULT_SEASON = "current"
FALLBACK_SEASON = "2023/24"

# Raw match statuses by bucket; other statuses keep their own name.
STATUS_BUCKETS = {
    "LIVE": ["IN_PLAY", "LIVE"],
    "HALFTIME": ["PAUSED", "HALFTIME"],
    "SCHEDULED": ["TIMED", "SCHEDULED", "Not Started"],
}
LIVE_STATUSES = ["IN_PLAY", "LIVE", "PAUSED", "HALFTIME"]
OPEN_STATUSES = ["TIMED", "SCHEDULED"]

# Upper table position of each tier.
TIERS = [(4, "TITLE CONTENDER"), (7, "EUROPEAN HOPEFUL"), (14, "MID-TABLE"), (17, "RELEGATION BATTLE")]
LAST_TIER = "RELEGATION ZONE"

# Least points per game of each momentum class.
MOMENTUM = [(2.2, "HOT"), (1.5, "STEADY"), (0.8, "COOLING")]
LOWEST_MOMENTUM = "COLD"

# Upper bound in degrees Celsius of each class.
TEMPERATURE_CLASSES = [(0, "Freezing"), (8, "Cold"), (15, "Cool"), (22, "Comfortable"), (30, "Warm")]
HOTTEST = "Hot"

# WMO weather code ranges: lowest code, highest code, pitch condition.
PITCH_CONDITIONS = [
    (0, 1, "Excellent"),
    (2, 3, "Good"),
    (45, 45, "Poor (Fog)"),
    (48, 48, "Poor (Fog)"),
    (51, 57, "Moderate (Drizzle)"),
    (61, 67, "Poor (Rain)"),
    (71, 77, "Poor (Snow)"),
    (80, 86, "Poor (Showers)"),
    (95, 2147483647, "Dangerous (Storm)"),
]

# WMO weather codes.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}

# Club names of the season CSV and their full names.
CLUB_NAMES = {
    "Man City": "Manchester City",
    "Man United": "Manchester United",
    "Nott'm Forest": "Nottingham Forest",
    "Spurs": "Tottenham Hotspur",
    "Tottenham": "Tottenham Hotspur",
    "Newcastle": "Newcastle United",
    "West Ham": "West Ham United",
    "Brighton": "Brighton & Hove Albion",
    "Wolves": "Wolverhampton Wanderers",
    "Luton": "Luton Town",
}

# Club ids 1 to 20 in this order; 99 is the id of an unknown club.
CLUBS_BY_ID = [
    "Manchester City",
    "Arsenal",
    "Liverpool",
    "Aston Villa",
    "Tottenham Hotspur",
    "Chelsea",
    "Newcastle United",
    "Manchester United",
    "West Ham United",
    "Brighton & Hove Albion",
    "Wolverhampton Wanderers",
    "Fulham",
    "Brentford",
    "Crystal Palace",
    "Nottingham Forest",
    "Everton",
    "Luton Town",
    "Burnley",
    "Sheffield United",
    "Bournemouth",
]
CLUB_IDS = {name: i for i, name in enumerate(CLUBS_BY_ID, 1)}
UNKNOWN_CLUB_ID = 99

# Season CSV constants.
SEASON_CSV = {"competition_id": 2324, "season_id": 2324, "season_name": "2023/2024", "kick_off": "15:00:00"}
CSV_DATE_FORMATS = ["dd/MM/yyyy", "dd/MM/yy"]
LAST_SHORT_YEAR = 2068
FIRST_CSV_MATCH_ID = 10001
FIRST_SCORER_ID = 50001

# Three-letter codes.
SHORT_CODES = {
    "Manchester City": "MCI",
    "Arsenal": "ARS",
    "Liverpool": "LIV",
    "Aston Villa": "AVL",
    "Tottenham Hotspur": "TOT",
    "Chelsea": "CHE",
    "Newcastle United": "NEW",
    "Manchester United": "MUN",
    "West Ham United": "WHU",
    "Brighton & Hove Albion": "BHA",
    "Wolverhampton Wanderers": "WOL",
    "Fulham": "FUL",
    "Brentford": "BRE",
    "Crystal Palace": "CRY",
    "Nottingham Forest": "NFO",
    "Everton": "EVE",
    "Burnley": "BUR",
    "Bournemouth": "BOU",
    "AFC Bournemouth": "BOU",
    "Sunderland": "SUN",
    "Leeds United": "LEE",
}

LAYERS = {"raw": "Bronze", "staging": "Silver", "mart": "Gold"}

# Event types of the live match view.
TOUCH_EVENTS = ["Pass", "Carry", "Ball Receipt*", "Dribble", "Shot"]
KEY_EVENTS = ["Shot", "Goal", "Card", "Substitution", "Foul Committed"]

# Freshness labels by highest age in minutes.
FRESHNESS_LABELS = [(20, "PASS_MATCHDAY_SLA"), (90, "PASS_OFFDAY_SLA")]
STALE_LABEL = "FAIL"

# Contracts of the feed records.
MATCH_CONTRACT = {
    "name": "football_data_match",
    "required": ["id", "utcDate", "status", "matchday", "homeTeam", "awayTeam"],
    "types": {"id": "int", "matchday": "int", "utcDate": "str", "status": "str"},
    "enums": {
        "status": [
            "SCHEDULED",
            "TIMED",
            "IN_PLAY",
            "PAUSED",
            "HALFTIME",
            "EXTRA_TIME",
            "PENALTY_SHOOTOUT",
            "FINISHED",
            "SUSPENDED",
            "POSTPONED",
            "CANCELLED",
            "AWARDED",
        ]
    },
    "ranges": {"matchday": (1, 38)},
    "nested": {"homeTeam": ["id", "name"], "awayTeam": ["id", "name"]},
}

STANDINGS_CONTRACT = {
    "name": "football_data_standings",
    "required": [
        "position",
        "team",
        "playedGames",
        "won",
        "draw",
        "lost",
        "points",
        "goalsFor",
        "goalsAgainst",
        "goalDifference",
    ],
    "types": {
        "position": "int",
        "playedGames": "int",
        "won": "int",
        "draw": "int",
        "lost": "int",
        "points": "int",
        "goalsFor": "int",
        "goalsAgainst": "int",
    },
    "enums": {},
    "ranges": {"position": (1, 20), "playedGames": (0, 38), "points": (0, 114)},
    "nested": {"team": ["id", "name"]},
}
