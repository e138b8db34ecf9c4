"""The lifecycle layers as DataFrame -> DataFrame operators."""
