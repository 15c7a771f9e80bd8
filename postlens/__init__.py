"""postlens: a PySpark-native engine for collections of semi-structured posting records."""
