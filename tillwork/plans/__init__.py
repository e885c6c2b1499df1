"""The reports: DataFrame -> DataFrame plans over canonical columns."""
