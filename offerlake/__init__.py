"""offerlake: a Spark-native job-offer lakehouse.

Raw feeds are landed immutably (bronze), conformed into one typed offer table
(silver) and modelled as a star schema with analytical marts (gold).  Every
transformation is a DataFrame / SQL expression planned by Catalyst; no Python
UDF sits in the data path.
"""

__version__ = "0.1.0"
