"""helixframe.operators"""
