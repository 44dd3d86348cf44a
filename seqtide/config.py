"""Parameter profiles, passed as arguments; nothing reads module globals."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The seven canonical ranks, highest first.
RANKS = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")


@dataclass(frozen=True)
class Profile:
    """Every tunable of a surveillance run."""

    # The habitat vocabulary and thresholds of the published run.
    habitat_terms: tuple[str, ...] = (
        "Aquatic", "Marine", "Freshwater", "Benthic", "Pelagic", "Planktonic")
    min_identity: float = 0.95
    min_coverage: float = 0.80
    dimension: int = 1024
    max_tokens: int = 2048
    encode_batch: int = 32
    cells: int = 8192
    layout_dims: int = 10
    layout_neighbours: int = 30
    layout_min_dist: float = 0.0
    seed: int = 42
    min_cluster_size: int = 50
    min_samples: int = 5
    ambiguous_below: float = 0.85
    vote_neighbours: int = 15
    family_floor: float = 0.95
    genus_floor: float = 0.5
    export_bytes: int = 4 * 1024 ** 3
    # Ours: how the distributed steps are sized.
    # 21 letters: chance holders of a k-mer stay rare up to 10^12 bases. 32 k-mers: two
    # sequences of 95 % identity share about a fifth of them, and none once in 10^3.
    kmer: int = 21
    kmers_per_sequence: int = 32
    probes: int = 32
    refine: int = 4
    block_rows: int = 2048
    levels: int | None = None


FULL = Profile()
DEMO = replace(FULL, max_tokens=512, cells=512, min_cluster_size=15, min_samples=3)
