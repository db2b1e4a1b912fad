"""The parameters of a report run: patterns, keywords, milestones and labels."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

MODO, RETAIL, OTHER = "MODO", "Retail", "Otro"

# Weekday names, Monday first.
WEEKDAYS = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


@dataclass(frozen=True)
class Rules:
    # Words a movement type holds, whatever its case.
    bet_words: tuple[str, ...] = ("apuesta", "jugada")
    broad_load_words: tuple[str, ...] = ("carga", "deposito", "depósito")
    withdrawal_words: tuple[str, ...] = ("retiro", "transferencia salida")
    prize_words: tuple[str, ...] = ("premio",)
    # Patterns on folded text, that is without accents in lower case.
    strict_load_pattern: str = r"^carga\s+saldo\s+desde\s*(?:modo|tj)\b"
    bonus_words: tuple[str, ...] = ("bonific",)
    signup_bonus_words: tuple[str, ...] = ("registro", "alta", "bienvenida")
    # Fixed value: what a bet's description says ahead of the game, whatever its case.
    game_prefix_pattern: str = r"jugada\s*-\s*"
    # Report name of a game and its pattern on the folded game name.
    game_patterns: tuple[tuple[str, str], ...] = (
        ("Tombo_Express", r"tombo express"),
        ("Tombola", r"t(?:o|ó)mbola"),
        ("Quini6", r"quini\s*6"),
        ("Loto_Plus", r"loto(?:\s*plus)?"),
    )
    new_games_pattern: str = r"quini\s*6|loto(?:\s*plus)?"
    # Channel keywords on folded text.
    modo_keywords: tuple[str, ...] = ("modo",)
    card_keywords: tuple[str, ...] = ("tj", "tarjeta")
    counter_keywords: tuple[str, ...] = ("agencia", "pos", "caja")
    # Launch of the games, start of the channel, sign-up years of "old" users.
    launch: datetime = datetime(2025, 4, 14)
    channel_start: datetime = datetime(2025, 7, 7)
    old_signup_years: tuple[int, int] = (2021, 2024)
    # Variants: strict or broad load filter, extended or binary channel rule.
    strict_loads: bool = True
    channel_rule: str = "extended"

    @property
    def channels(self) -> tuple[str, ...]:
        """Channels a load can have; fixes the columns of the channel pivots."""
        if self.strict_loads or self.channel_rule == "binary":
            return (MODO, RETAIL)
        return (MODO, RETAIL, OTHER)
