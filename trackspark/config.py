"""Table schemas, match constants and the roster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

# ---- Fixed values: table layouts ---------------------------------------------------------

RAW_SCHEMA = StructType(
    [StructField("sid", IntegerType()), StructField("ts", LongType())]
    + [StructField(c, IntegerType()) for c in ("x", "y", "z")]
    + [StructField(c, LongType()) for c in ("v_abs", "a_abs")]
    + [StructField(c, IntegerType()) for c in ("vx", "vy", "vz", "ax", "ay", "az")]
)

CLEAN_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + [
        StructField("half", IntegerType()),
        *(StructField(c, DoubleType()) for c in (
            "matchSecond", "x_m", "y_m", "z_m", "speed_m_s", "speed_kmh", "acceleration_m_s2")),
    ]
)

CHUNKED_SCHEMA = StructType(CLEAN_SCHEMA.fields + [StructField("chunkId", IntegerType())])
# chunks of many matches, in folders match_id=/chunkId=
MATCH_CHUNKED_SCHEMA = StructType(CHUNKED_SCHEMA.fields + [StructField("match_id", IntegerType())])

POSITION_SCHEMA = StructType(
    [
        StructField("sid", IntegerType()),
        StructField("ts", LongType()),
        StructField("x", DoubleType()),
        StructField("y", DoubleType()),
        StructField("z", DoubleType()),
        StructField("half", IntegerType()),
        StructField("matchSecond", DoubleType()),
        StructField("speed_kmh", DoubleType()),
    ]
)


# ---- Fixed values: match clock, units, thresholds ----------------------------------------

@dataclass(frozen=True)
class MatchConfig:
    """Constants of one match; pass a changed copy to any operator that takes ``cfg``."""

    # clock: two closed intervals in picoseconds
    first_half_start_ts: int = 10_753_295_594_424_116
    first_half_end_ts: int = 12_557_295_594_424_116
    second_half_start_ts: int = 13_086_639_146_403_495
    second_half_end_ts: int = 14_879_639_146_403_495
    ts_per_second: int = 1_000_000_000_000
    # metadata files count the second half from 1800 s, the tracking clock from 1804 s
    metadata_half_offset_s: float = 1800.0
    metadata_absolute_slack_s: float = 60.0
    chunk_seconds: int = 1

    # field in millimetres
    x_min: int = -68_000
    x_max: int = 68_000
    y_min: int = -32_500
    y_max: int = 32_500

    # sampling and running zones
    ball_sample_s: float = 0.0005
    player_sample_s: float = 0.005
    sprint_kmh: float = 24.0
    high_speed_kmh: float = 14.0
    low_speed_kmh: float = 11.0
    trot_kmh: float = 1.0
    watermark: str = "5 seconds"
    stats_window: str = "1 minute"
    trigger: str = "1 second"

    # heatmap
    heat_cols: int = 80
    heat_rows: int = 50
    kernel_radius: int = 5
    kernel_sigma: float = 2.0
    kernel_min_weight: float = 0.01
    grid_clamp: float = 0.9999
    zmax_percentile: float = 0.95
    heat_centre_x: tuple[int, int] = (-65_000, 65_000)
    heat_centre_y: tuple[int, int] = (-34_000, 34_000)

    # display transform
    pitch_scale_x: float = 2.0
    pitch_scale_y: float = 1.0
    pitch_offset_x: float = -6000.0
    pitch_offset_y: float = -31000.0
    heat_offset_x: float = 0.0
    heat_offset_y: float = -31000.0

    # tactics
    possession_high_mm: float = 1500.0
    possession_medium_mm: float = 3000.0
    possession_low_mm: float = 5000.0
    possession_radius_m: float = 3.0
    pressure_radius_m: float = 5.0
    player_anomaly_kmh: float = 40.0
    ball_anomaly_kmh: float = 180.0
    min_visible_players: int = 12
    momentum_possession: float = 35.0
    momentum_ball: float = 25.0
    momentum_pressure: float = 5.0
    momentum_runner: float = 4.0
    momentum_cap: float = 20.0
    momentum_alpha: float = 0.15
    history_rows: int = 300
    rolling_possession_s: float = 60.0
    trail_ticks: int = 5

    @property
    def second_half_offset_s(self) -> float:
        return (self.first_half_end_ts - self.first_half_start_ts) / self.ts_per_second

    @property
    def match_seconds(self) -> float:
        second = (self.second_half_end_ts - self.second_half_start_ts) / self.ts_per_second
        return self.second_half_offset_s + second

    @property
    def last_tick(self) -> int:
        return int(self.match_seconds)


MATCH = MatchConfig()

TEAM_A = "Team A"
TEAM_B = "Team B"
TEAMS = (TEAM_A, TEAM_B)
NEUTRAL = "Neutral"
LOOSE_BALL = "Loose Ball"
ZONES = ("Standing", "Trot", "Low-Speed Run", "High-Speed Run", "Sprint")

# ---- Fixed values: sensors ---------------------------------------------------------------

BALL_SIDS = (4, 8, 10, 12)
BALL_SIDS_BY_HALF = {1: (4, 8, 10), 2: (4, 8, 10, 12)}

# name, team, role, foot sensors, extra sensors
PLAYERS = (
    ("Nick Gertje", TEAM_A, "Goalkeeper", (13, 14), (97, 98)),
    ("Dennis Dotterweich", TEAM_A, "Defender", (47, 16), ()),
    ("Niklas Waelzlein", TEAM_A, "Defender", (49, 88), ()),
    ("Wili Sommer", TEAM_A, "Defender", (19, 52), ()),
    ("Philipp Harlass", TEAM_A, "Defender", (53, 54), ()),
    ("Roman Hartleb", TEAM_A, "Midfielder", (23, 24), ()),
    ("Erik Engelhardt", TEAM_A, "Forward", (57, 58), ()),
    ("Sandro Schneider", TEAM_A, "Forward", (59, 28), ()),
    ("Leon Krapf", TEAM_B, "Goalkeeper", (61, 62), (99, 100)),
    ("Kevin Baer", TEAM_B, "Midfielder", (63, 64), ()),
    ("Luca Ziegler", TEAM_B, "Defender", (65, 66), ()),
    ("Ben Mueller", TEAM_B, "Midfielder", (67, 68), ()),
    ("Vale Reitstetter", TEAM_B, "Midfielder", (69, 38), ()),
    ("Christopher Lee", TEAM_B, "Defender", (71, 40), ()),
    ("Leon Heinze", TEAM_B, "Forward", (73, 74), ()),
    ("Leo Langhans", TEAM_B, "Forward", (75, 44), ()),
)

OFFICIALS = (("Referee", "Referee", (105, 106), ()),)

# match-event folder -> message prefix
EVENT_PREFIXES = {"Game Interruption": "Match Control", "Shot on Goal": "Shot by"}
