"""sensorgrid: conditioning, aligning and modelling regular sensor time
series as Spark DataFrame operators."""

__version__ = "0.1.0"
