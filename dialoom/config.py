"""Fixed values of the dialogue data set, and the settings that decide its audio."""

from __future__ import annotations

from dataclasses import asdict, dataclass

# Record rules.
SPLITS = ("train", "validation", "test")
EXPECTED_COUNTS = {"train": 2700, "validation": 150, "test": 150}
SPEAKERS = ("user", "assistant")
MIN_TURNS, MAX_TURNS = 2, 8
CATEGORIES = ("general_conversation", "identity_facts", "identity_variations", "legacy_identity_corrections", "russian_language_status", "conversation_control")
MAX_UTTERANCE_CHARS = 400

# Voices and their ranges.
ASSISTANT_VOICE, ASSISTANT_SPEED, ASSISTANT_LANG = "af_heart", 1.0, "a"
VOICE_POOLS = {
    "train": (
        "af_alloy", "af_aoede", "af_bella", "af_jessica", "af_kore", "af_nicole", "af_nova", "am_adam", "am_echo",
        "am_fenrir", "am_michael", "am_onyx", "am_puck", "bf_emma", "bf_isabella", "bm_fable", "bm_george", "bm_lewis",
    ),
    "validation": ("af_sarah", "am_eric", "bf_alice", "bm_daniel"),
    "test": ("af_river", "af_sky", "am_liam", "am_santa", "bf_lily"),
}
SPEED_MIN, SPEED_MAX = 0.92, 1.08
PAUSE_MIN, PAUSE_MAX = 0.25, 0.75

# Signals, alignments and reports.
CHARS_PER_SECOND, PAUSE_ESTIMATE, BYTES_PER_SECOND = 15.0, 0.5, 96_000
ALIGNED_SPEAKER = "SPEAKER_MAIN"
ALIGNMENT_TOLERANCE, DURATION_TOLERANCE, MIN_PLAUSIBLE_SECONDS = 0.05, 0.01, 0.3
SPEECH_FLOOR, LIMITER_CEILING = 1e-4, 0.98
PERCENTILES = (0, 25, 50, 75, 90, 95, 99, 100)


@dataclass(frozen=True)
class GenerationConfig:
    """Settings of one generation run; those of ``gates()`` judge the audio and don't change it."""

    sample_rate: int = 24_000
    channels: int = 2
    fade_seconds: float = 0.015
    chunk_pause_seconds: float = 0.12
    min_utterance_seconds: float = 0.05
    max_dialogue_seconds: float = 600.0
    clipping_peak_threshold: float = 1.0 + 1e-6
    alignment_min_confidence: float = 0.55
    assistant_voice: str = ASSISTANT_VOICE
    assistant_speed: float = ASSISTANT_SPEED
    speed_range: tuple[float, float] = (SPEED_MIN, SPEED_MAX)
    pause_range: tuple[float, float] = (PAUSE_MIN, PAUSE_MAX)
    seed: int = 0

    @staticmethod
    def gates() -> tuple[str, ...]:
        return ("clipping_peak_threshold", "alignment_min_confidence", "max_dialogue_seconds", "min_utterance_seconds")

    def as_dict(self) -> dict:
        return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}

    def audio_dict(self) -> dict:
        """What a finished record depends on: everything but the gates."""
        return {k: v for k, v in self.as_dict().items() if k not in self.gates()}
