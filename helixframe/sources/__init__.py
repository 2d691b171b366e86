"""helixframe.sources"""
