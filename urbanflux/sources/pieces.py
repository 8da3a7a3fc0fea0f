"""Which folders hold versions 1 to N, when small ones are folded into larger ones now and then."""

from __future__ import annotations

from urbanflux.schemas import columns

FOLDS = columns("first long, last long")
#: Pieces of one size that are folded together.
FOLD_AT = 8
Piece = tuple[int, int]


def covering(last: int, folds: list[Piece]) -> list[Piece]:
    """The fewest pieces, each a range of versions, that hold versions 1 to ``last``."""
    longest: dict[int, int] = {}
    for first, end in folds:
        if end <= last:
            longest[first] = max(longest.get(first, 0), end)
    pieces, at = [], 1
    while at <= last:
        end = longest.get(at, at)
        pieces.append((at, end))
        at = end + 1
    return pieces


def to_fold(pieces: list[Piece], at: int = FOLD_AT) -> Piece | None:
    """The newest pieces of one size, as a range, once there are ``at`` of them."""
    width = lambda p: p[1] - p[0] + 1
    tail = [p for p in pieces if width(p) == width(pieces[-1])]
    return (tail[0][0], tail[-1][1]) if len(tail) >= at else None


def inside(pieces: list[Piece], span: Piece) -> list[Piece]:
    return [p for p in pieces if span[0] <= p[0] and p[1] <= span[1]]


def piece_name(piece: Piece) -> str:
    """``7`` for a version, ``1-8`` for a folded range."""
    first, last = piece
    return str(first) if first == last else f"{first}-{last}"


def piece_of(name: str) -> Piece:
    first, _, last = name.partition("-")
    return int(first), int(last or first)
