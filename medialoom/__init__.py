"""medialoom: DataFrame operators for keeping a labelled media dataset up to date."""

__version__ = "0.1.0"
