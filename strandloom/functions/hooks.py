"""Named hooks: readers, writers and predicates that a user puts in place of ours.

A configuration names a hook; an adapter reads the models of an annotation from where a user keeps it, and writes updated ones back.
"""

from __future__ import annotations

import importlib
from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HOOKS: dict[str, Callable] = {}


def register(name: str, hook: Callable) -> None:
    _HOOKS[name] = hook


def resolve(name: str) -> Callable:
    """A registered hook, or the callable that 'package.module:function' names."""
    if name in _HOOKS:
        return _HOOKS[name]
    module, _, function = name.partition(":")
    if not function:
        raise KeyError(f"no hook {name!r}")
    return getattr(importlib.import_module(module), function)


class AnnotationAdapter(ABC):
    """Where an annotation is kept: models are rows (contig, gene_id, model_id, strand, exons, cds)."""

    @abstractmethod
    def models(self, spark: SparkSession) -> DataFrame:
        """The annotation as it is."""

    @abstractmethod
    def write(self, models: DataFrame) -> None:
        """Puts updated models where they belong."""


class Gff3Adapter(AnnotationAdapter):
    """Models in GFF3 text files, written as one folder of lines in (contig, gene, model) order."""

    def __init__(self, source: str, target: str | None = None):
        self.source, self.target = source, target

    def models(self, spark: SparkSession) -> DataFrame:
        from strandloom.sources import formats

        return formats.gff3_genes(formats.lines(spark, self.source))

    def lines(self, models: DataFrame) -> DataFrame:
        from strandloom.operators.gene import gff3_lines

        return gff3_lines(models).orderBy("contig", "gene_id", "model_id", "level", "lend").select("value")

    def write(self, models: DataFrame) -> None:
        self.lines(models).write.text(self.target)


class GtfAdapter(Gff3Adapter):
    """The same in GTF; sequences (contig, seq) say where codons are, and the coding parts read back hold the stop codon again."""

    def __init__(self, source: str, target: str | None = None, sequences: DataFrame | None = None):
        super().__init__(source, target)
        self.sequences = sequences

    def models(self, spark: SparkSession) -> DataFrame:
        from pyspark.sql import functions as F

        from strandloom.operators.gene import joined
        from strandloom.sources import formats

        rows = formats.gtf_genes(formats.lines(spark, self.source))
        return rows.select("contig", "gene_id", "model_id", "strand", "exons", joined(F.concat("cds", "stop_codon")).alias("cds"))

    def lines(self, models: DataFrame) -> DataFrame:
        from strandloom.operators.gene import gtf_lines, with_sequences

        return gtf_lines(with_sequences(models, self.sequences)).orderBy("contig", "gene_id", "model_id", "lend").select("value")


register("gff3", Gff3Adapter)
register("gtf", GtfAdapter)
