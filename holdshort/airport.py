"""Reference data of the airport the library ships with.

All tables here are constants whose size does not depend on the data: 21 holding points, 4 runways,
24 holidays. They are folded into column expressions instead of being joined.
"""

from __future__ import annotations

# Airport centre (lat, lon) and the radius, in metres, of the area kept around it.
CENTRE = (40.49291, -3.56974)
CENTRE_RADIUS_M = 5000.0

# Receiver position (lat, lon).
RADAR = (40.51, -3.53)

# Holding points (designator, runway, lon, lat). The list order decides overlaps.
HOLDING_POINTS = [
    ("Z1", "36L/18R", -3.573093114831562, 40.490653160130186),
    ("KA6", "32R/14L", -3.537524367869231, 40.472076292010001),
    ("KA8", "32R/14L", -3.536653485337274, 40.466622566754253),
    ("K3", "32R/14L", -3.558959606954449, 40.494122669084419),
    ("K2", "32R/14L", -3.559326044131887, 40.4945961819448),
    ("K1", "32R/14L", -3.560411408421098, 40.495554592925956),
    ("Y1", "36R/18L", -3.560656492186808, 40.499431092287409),
    ("Y2", "36R/18L", -3.560645785166937, 40.500298406173002),
    ("Y3", "36R/18L", -3.560660061193443, 40.501183565039504),
    ("Y7", "36R/18L", -3.560800449906033, 40.533391949745102),
    ("Z6", "36L/18R", -3.576129307304151, 40.495184843931881),
    ("Z4", "36L/18R", -3.576034129003182, 40.492555539298088),
    ("Z2", "36L/18R", -3.575903257941006, 40.491865496230126),
    ("Z3", "36L/18R", -3.57319305240692, 40.491819096186241),
    ("LF", "32L/14R", -3.572566658955927, 40.479721203031424),
    ("L1", "32L/14R", -3.57652786733783, 40.483565816902733),
    ("LA", "32L/14R", -3.577181028787666, 40.484251101106899),
    ("LB", "32L/14R", -3.577553413710587, 40.484873329796898),
    ("LC", "32L/14R", -3.575750378154376, 40.486690643924192),
    ("LD", "32L/14R", -3.575150753600524, 40.486522892072891),
    ("LE", "32L/14R", -3.574915186586964, 40.485580625293494),
]

# Runway rectangles as closed rings of (lon, lat). The order decides overlaps.
RUNWAY_RINGS = {
    "36R/18L": [
        (-3.560314698993372, 40.536214953564219),
        (-3.560115619892884, 40.499859371026062),
        (-3.558758924220036, 40.499866800139706),
        (-3.558958003320524, 40.536222382677863),
        (-3.560314698993372, 40.536214953564219),
    ],
    "32R/14L": [
        (-3.560616443164626, 40.49648882920043),
        (-3.530233771171787, 40.466560555412769),
        (-3.529390530746063, 40.467416598679677),
        (-3.559773202738903, 40.49734487246733),
        (-3.560616443164626, 40.49648882920043),
    ],
    "36L/18R": [
        (-3.575312220900675, 40.533035679421005),
        (-3.575065318943644, 40.492052937902109),
        (-3.574163865545885, 40.492058368739578),
        (-3.574410767502916, 40.533041110258473),
        (-3.575312220900675, 40.533035679421005),
    ],
    "32L/14R": [
        (-3.545264836113798, 40.455701584425526),
        (-3.576990231488946, 40.486626436878893),
        (-3.577924321488386, 40.485668166355438),
        (-3.546198926113238, 40.454743313902071),
        (-3.545264836113798, 40.455701584425526),
    ],
}

# Numbered runway reference positions (name, lat, lon) used by the wait statistics.
NUMBERED_RUNWAYS = [
    ("1", 40.463, -3.554),
    ("2", 40.473, -3.536),
    ("3", 40.507, -3.574),
    ("4", 40.507, -3.559),
]

# Where a runway's errors are drawn (runway, lon, lat).
RUNWAY_LABEL_POSITIONS = [
    ("32L/14R", -3.575695, 40.484656),
    ("32R/14L", -3.558139, 40.495018),
    ("36L/18R", -3.574648, 40.501333),
    ("36R/18L", -3.559239, 40.504447),
]

# Public holidays of the airport's region.
HOLIDAYS = [
    "2024-01-01", "2024-01-06", "2024-03-28", "2024-03-29", "2024-05-01", "2024-05-02",
    "2024-07-25", "2024-08-15", "2024-10-12", "2024-11-01", "2024-12-06", "2024-12-25",
    "2025-01-01", "2025-01-06", "2025-04-17", "2025-04-18", "2025-05-01", "2025-05-02",
    "2025-07-25", "2025-08-15", "2025-11-01", "2025-12-06", "2025-12-08", "2025-12-25",
]

HOLDING_POINT_NAMES = [name for name, _, _, _ in HOLDING_POINTS]
RUNWAY_NAMES = list(RUNWAY_RINGS)


def runway_column(runway: str) -> str:
    """Column name of a runway flag: `/` is not usable in names."""
    return runway.replace("/", "_")
