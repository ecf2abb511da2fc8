"""gridspark: gridded geospatial analytics and corpus preparation as Spark plans."""
